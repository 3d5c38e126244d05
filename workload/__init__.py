"""The registered queries: each operator of the engine over the given tables."""

from .registry import oracles, registered
from . import scans, shapes, tables  # noqa: F401  (the modules register their queries)

__all__ = ["oracles", "registered"]
