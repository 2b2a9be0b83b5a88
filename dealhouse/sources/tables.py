"""Access to the driver's parquet tables (one file or folder per table)."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


class DriverTables:
    """Lazy parquet readers; Catalyst prunes columns and pushes filters into
    each scan, so callers simply select what they need."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self.table("region")
