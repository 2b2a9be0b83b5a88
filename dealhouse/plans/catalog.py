"""The layers as tables of the session's catalog, for SQL by name.

Each layer is a database with its own location under a shared root. Tables are made by
``saveAsTable`` and replaced by ``INSERT OVERWRITE ... BY NAME``; partitions of the fact by a dynamic
overwrite, and a requested value without rows by dropping its partition. Any session catalog does,
the in-memory one too. ``Warehouse`` keeps versions and swaps them at once; a catalog table has its
present rows only, so readers should not run while it is replaced.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.operators import staging as stg
from dealhouse.operators.merge import scd1_merge
from dealhouse.operators.sequence import SMALL
from dealhouse.plans import marts

LAYERS = ("raw", "staging", "analytics")


class CatalogStore:
    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        """Databases ``<prefix><layer>`` with their files under ``root``."""
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}{layer}`.`{table}`"

    def create_namespaces(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` LOCATION '{self.root}/{layer}'")

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def write(self, layer: str, table: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """The whole table: made on the first load, overwritten later, columns matched by name."""
        if not self.exists(layer, table):
            df.write.partitionBy(*partition_by).format("parquet").saveAsTable(self.name(layer, table))
            return
        for f in df.schema:
            self.ensure_column(layer, table, f.name, f.dataType)
        self._insert(layer, table, df, "static")

    def _insert(self, layer: str, table: str, df: DataFrame, mode: str) -> None:
        view = f"incoming_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            self.spark.sql(f"INSERT OVERWRITE {self.name(layer, table)} BY NAME SELECT * FROM {view}")
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
            self.spark.catalog.dropTempView(view)

    def ensure_column(self, layer: str, table: str, column: str, kind: T.DataType) -> None:
        """Add ``column`` if the table lacks it; rows that are there have null in it."""
        if column not in self.read(layer, table).columns:
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS (`{column}` {kind.simpleString()})")

    def replace_partitions(self, layer: str, table: str, df: DataFrame, column: str, values: Sequence[int]) -> None:
        """Every one of ``values`` ends up with exactly the rows that ``df`` has for it."""
        rows = df.filter(F.col(column).isin(list(values))).hint("rebalance", F.col(column))
        if not self.exists(layer, table):
            rows.write.partitionBy(column).format("parquet").saveAsTable(self.name(layer, table))
            return
        self._insert(layer, table, rows, "dynamic")
        kept = {r[0] for r in self.read(layer, table).select(column).distinct().collect()}  # partition values
        filled = {r[0] for r in rows.select(column).distinct().collect()}
        for v in sorted((set(values) & kept) - filled):
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} DROP IF EXISTS PARTITION (`{column}` = {v})")

    def merge(self, layer: str, table: str, source: DataFrame, keys: list[str], columns: list[str]) -> None:
        """SCD1 upsert; the next state is written beside the table before it takes its place."""
        if not self.exists(layer, table):
            self.write(layer, table, source.select(*columns))
            return
        path = f"{self.root}/_merge/{uuid.uuid4().hex}"
        rows = source.select(*columns)
        rows.write.parquet(f"{path}/source")  # the merge reads it twice
        source = self.spark.read.schema(rows.schema).parquet(f"{path}/source")
        merged = scd1_merge(self.read(layer, table), source, keys, columns)
        merged.write.parquet(f"{path}/next")
        self.write(layer, table, self.spark.read.schema(merged.schema).parquet(f"{path}/next"))

    def reset_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{layer}` CASCADE")


def refresh(store: CatalogStore, sources: Mapping[str, DataFrame], run_ts: dt.datetime,
            years: Sequence[int] = marts.YEAR_DOMAIN) -> None:
    """Land, stage and model ``sources`` into catalog tables; the fact's ``years`` are replaced."""
    store.create_namespaces()
    for n, df in sources.items():
        store.write("raw", n, df)
        store.write("staging", n, stg.STAGERS[n](store.read("raw", n)))
    store.write("staging", "transactions_quarantine", stg.transactions_quarantine(store.read("raw", "transactions")))
    for dim, key, columns in (("dim_acquirer", "acquirer_id", marts.DIM_ACQUIRER_COLUMNS),
                              ("dim_target", "target_id", marts.DIM_TARGET_COLUMNS)):
        staged = store.read("staging", f"{dim.removeprefix('dim_')}s")
        store.merge("analytics", dim, marts.dimension_rows(staged, columns, run_ts), [key], columns)
    deals, targets, buyers = (store.read(*t) for t in (
        ("staging", "transactions"), ("analytics", "dim_target"), ("analytics", "dim_acquirer")))
    store.merge("analytics", "dim_acquirer_activity", marts.dim_acquirer_activity(deals, targets, buyers, run_ts, SMALL),
                ["acquirer_id"], marts.ACTIVITY_COLUMNS)
    store.write("analytics", "rpt_sector_trend_summary", marts.rpt_sector_trend_summary(deals, targets, run_ts.date()))
    store.write("analytics", "fct_target_deal_sequence",
                marts.fct_target_deal_sequence(deals, targets, run_ts.date(), SMALL))
    store.replace_partitions("analytics", "fct_transactions", marts.fct_transactions(
        deals, targets, buyers, store.read("staging", "sector_multiples"),
        store.read("staging", "acquirer_financials"), run_ts.date()), "deal_year", list(years))
