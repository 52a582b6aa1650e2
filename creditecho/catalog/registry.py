"""A query pairs a Spark function of (spark, sf_dir) with the DuckDB statement it must equal."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    runs: dict[str, Run] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        def keep(run: Run) -> Run:
            if name in self.runs:
                raise ValueError(f"query {name} is registered twice")
            self.runs[name] = run
            if sql is not None:
                self.sql[name] = sql.strip()
            return run

        return keep


def rounded(df: DataFrame, digits: int = 6, **own: int) -> DataFrame:
    """Rounds double columns so that two engines can be compared; ``own`` sets other digits per column."""
    columns = {
        c: F.round(F.col(c), own.get(c, digits)) + 0.0 for c, t in df.dtypes if t in ("double", "float")
    }
    return df.withColumns(columns)
