"""Column-level helpers: time axis, chunk keys and paths, message formatting."""
from tickgate.functions import fmt, keys, timez  # noqa: F401
