"""folioworks: a Spark-native engine for transcription corpora and text tables.

The names below are the public ones; they are loaded when first used.
"""

from __future__ import annotations

import importlib

__version__ = "0.2.0"

_WHERE = {
    "errors": "EngineError ParseError InvalidFormatError MalformedLocusError MissingPageContextError ValidationError SchemaError CharacterError DataIntegrityError BuildError SourceNotFoundError ExportError SmokeTestError ConfigurationError",
    "logs": "get_logger configure",
    "functions.charset": "BASIC RARE SINGLE COMPOUNDS SEPARATORS LINE_MARKERS EDITORIAL CLEAN character_table describe is_valid_word compound_counts validate",
    "functions.text": "strip_markup clean_for_analysis extract_text normalize_for_comparison",
    "functions.ids": "parse_page_id reading_order section_of_page uncertain_section",
    "sources.ivtff": "Transcription read_ivtff parse_text read_lines pages loci",
    "sources.tables": "Source read_jsonl read_registry fetch load_sources",
    "sources.sinks": "write_canonical_jsonl write_parquet write_split manifest",
    "operators.lines": "build_lines line_table run_smoke_test",
    "operators.metadata": "build_metadata page_records folio_records quire_records",
    "operators.mismatch": "build_mismatch_index align compare",
    "operators.quality": "load_schema validate_records schema_violations invariant_failures verify_invariants",
    "operators.verification": "profile verify_source verify_all",
}
_MODULE = {name: module for module, names in _WHERE.items() for name in names.split()}
__all__ = ["__version__", *_MODULE]


def __getattr__(name: str):
    if name not in _MODULE:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(importlib.import_module(f".{_MODULE[name]}", __name__), name)


def __dir__() -> list[str]:
    return sorted({*globals(), *__all__})
