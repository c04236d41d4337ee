"""A workspace bundles the bronze source with lazily-built silver and gold
layers, so every query of one scale factor shares the same plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.facts import Gold
from ..operators.silver import Silver
from ..sources.bronze import bronze_scan
from ..sources.fixtures import FixtureBronze


class LandedBronze:
    """Bronze tables read back from landed Parquet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._cache = {}

    def table(self, name: str):
        if name not in self._cache:
            self._cache[name] = bronze_scan(self.spark, self.root, name)
        return self._cache[name]


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, bronze=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.fixtures = FixtureBronze(spark, sf_dir) if sf_dir else None
        self.bronze = bronze if bronze is not None else self.fixtures
        self.silver = Silver(self.bronze)
        self.gold = Gold(self.silver)
