"""Errors that callers can tell apart."""


class WebloomError(Exception):
    """Base of all errors that this package raises on purpose."""


class ConfigError(WebloomError):
    """A configuration file or an override is missing, malformed or out of range."""


class DataSourceError(WebloomError):
    """An input lacks a column, has a wrong type or holds invalid rows."""


class ScopeFilterError(WebloomError):
    """A scope expression can't be compiled."""


class JobError(WebloomError):
    """A job's step failed."""
