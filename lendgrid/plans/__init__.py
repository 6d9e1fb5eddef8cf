from . import cuts, glms, portfolio, records, results, scores, segments  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
