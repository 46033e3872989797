"""tickgate: market-bar quality checks and publishing as Spark DataFrame jobs."""
from tickgate.config import ValidationConfig  # noqa: F401

__version__ = "0.1.0"
