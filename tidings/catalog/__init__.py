"""All registered queries."""

from importlib import import_module

from tidings.catalog.registry import SPARK, SQL

for _part in ("frames", "features", "evaluate", "relations", "classify", "answers", "jobs", "leaderboard", "files"):
    import_module(f"tidings.catalog.{_part}")

__all__ = ["SPARK", "SQL"]
