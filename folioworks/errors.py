"""Errors of the engine; every one carries ``details`` that its text shows."""

from __future__ import annotations


class EngineError(Exception):
    """Base of all errors here."""

    def __init__(self, message: str, **details):
        super().__init__(message)
        self.message = message
        self.details = {k: v for k, v in details.items() if v is not None}

    def __str__(self) -> str:
        shown = ", ".join(f"{k}={v!r}" for k, v in self.details.items())
        return f"{self.message} ({shown})" if shown else self.message


class ParseError(EngineError, ValueError):
    """Input that cannot be read; shows 100 characters of the line at most."""

    def __init__(self, message: str, line_number: int | None = None, line_content: str | None = None, **details):
        super().__init__(message, line_number=line_number, line_content=line_content and line_content[:100], **details)


class InvalidFormatError(ParseError):
    pass


class MalformedLocusError(ParseError):
    pass


class MissingPageContextError(ParseError):
    pass


class ValidationError(EngineError, ValueError):
    """Data that breaks a rule."""


class SchemaError(ValidationError):
    pass


class CharacterError(ValidationError):
    pass


class DataIntegrityError(ValidationError):
    pass


class BuildError(EngineError):
    """A build that cannot be finished."""


class SourceNotFoundError(BuildError, FileNotFoundError):
    pass


class ExportError(BuildError, RuntimeError):
    pass


class SmokeTestError(BuildError):
    pass


class ConfigurationError(EngineError):
    pass
