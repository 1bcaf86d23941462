"""Exceptions raised by the library."""


class TidemillError(Exception):
    """Base class."""


class FormatError(TidemillError, ValueError):
    """A source does not have the expected shape."""


class QualityError(TidemillError):
    """A data quality gate did not pass."""


class FlowError(TidemillError):
    """A step of a flow failed; the cause is chained."""


class ConfigError(TidemillError, ValueError):
    """A configuration is incomplete or names something unknown."""
