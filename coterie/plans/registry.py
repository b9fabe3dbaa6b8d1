"""What a registered query is."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    """A query over the fixture tables and, where SQL can express it, the equivalent SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Registry(dict):
    """Queries by name."""

    def add(self, name: str, sql: str | None = None):
        def register(run):
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(run, sql)
            return run

        return register
