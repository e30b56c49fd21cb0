"""All registered queries over the driver's tables, each beside its SQL."""

from . import audit, codebase, core, gates, lists, merge, parser, sentences, sources, streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
