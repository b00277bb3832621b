"""The registered queries and their SQL counterparts.

A query binds operators of the library to the driver's tables: a document is a
page, its lines are its text between line feeds, its language and source stand
for language and hand; orders and line items become a synthetic transcription.
"""

from __future__ import annotations

from . import alignment, checks, files, statistics, transcription
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "alignment", "checks", "files", "statistics", "transcription"]
