"""Bronze tables derived from the generated test tables.

The projections live in :mod:`fixture_sql`; here they are run by Spark
against the Parquet inputs of one scale factor and conformed to the
bronze layout (every declared column present, all strings; absent ones
NULL, exactly what a by-name union of files would give).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from . import fixture_sql
from .bronze import conform_bronze


class FixtureBronze:
    """Bronze tables of one test-data directory, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def _src(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def _sources(self) -> dict[str, DataFrame]:
        return {n: self._src(n) for n in ("events", "lineitem", "part")}

    def _run(self, body: str) -> DataFrame:
        text = fixture_sql.with_helpers(body)
        used = {k: v for k, v in self._sources.items() if "{" + k + "}" in text}
        return self.spark.sql(text, **used)

    def raw(self, table: str) -> DataFrame:
        """The projection exactly as written (only the columns it produces)."""
        return self._run(fixture_sql.BRONZE[table])

    def table(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = conform_bronze(self.raw(table), table)
        return self._tables[table]

    def parts_rounds(self, every: bool = False) -> DataFrame:
        return self._run(fixture_sql.PARTS_OF_EVERY if every else fixture_sql.EXTRA["parts_rounds"])

    def manifest(self) -> DataFrame:
        return self._run(fixture_sql.EXTRA["manifest"])
