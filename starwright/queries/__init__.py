"""The query catalogue: each operator and plan on the shared test tables.

Every query comes with the SQL that must give the same rows on the same
tables, except where SQL cannot say it.
"""

from starwright.queries import dimensions, expressions, facts, files, reviews, stars, tables
from starwright.queries.registry import REGISTRY

__all__ = ["REGISTRY", "dimensions", "expressions", "facts", "files", "reviews", "stars", "tables"]
