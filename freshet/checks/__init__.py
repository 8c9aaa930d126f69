"""Every operator run over the driver tables, next to the same result in SQL."""

from freshet.checks import columns, cubes, datasets, formulas, grouped, landing, ordered, revisions, shapes, storage  # noqa: F401
from freshet.checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
