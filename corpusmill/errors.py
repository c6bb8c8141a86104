"""Errors of the engine; the command line turns them into messages."""


class CorpusError(Exception):
    """Any failure that the engine names itself."""


class ConfigError(CorpusError, ValueError):
    """A setting is out of range or contradicts another."""


class SourceError(CorpusError):
    """Source data could not be fetched, or are not what was announced."""


class FormatError(CorpusError, ValueError):
    """Source data do not have the form they must have."""


class ValidationError(CorpusError):
    """Produced data break the contract."""
