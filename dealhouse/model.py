"""The warehouse as one lazy plan graph over the driver tables.

``Model`` wires raw -> staging -> dimensions -> marts without writing
anything; the pipeline (``dealhouse.plans.pipeline``) materialises the same
functions layer by layer. Queries in ``dealhouse.queries`` read from here.
"""
from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealhouse.operators import staging as stg
from dealhouse.plans import marts
from dealhouse.sources.entities import RAW_BUILDERS
from dealhouse.sources.tables import DriverTables

# Views whose staging filter would otherwise be rewritten into the view.
OBSERVED_RAW = frozenset({"transactions"})
# Rule tables of the order data that stands in for deals: EV/EBITDA bounds by deal type (types that are not listed
# have none), and the financing that each deal type may have.
MULTIPLE_BY_DEAL_TYPE = {"1-URGENT": (0.0, 7.0), "2-HIGH": (0.0, 7.5), "5-LOW": (4.0, 100.0)}
FINANCING_BY_DEAL_TYPE = {"1-URGENT": ("A", "N"), "2-HIGH": ("A", "N", "R"), "3-MEDIUM": ("A", "N", "R"),
                          "4-NOT SPECIFIED": ("A", "N", "R"), "5-LOW": ("N", "R")}
# Pinned run timestamp for reproducible stamps in queries and tests.
RUN_TS = dt.datetime(2025, 1, 1, 0, 0, 0)


class Model:
    _shared: dict[tuple, "Model"] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Model":
        """One plan graph per (live session, input folder, run stamp).

        Only DataFrame definitions are reused (driver-side plan objects over
        read-only inputs); nothing is cached in memory or on disk."""
        key = (id(spark._jsparkSession), sf_dir.rstrip("/"), RUN_TS)
        m = cls._shared.get(key)
        if m is None or m.spark is not spark:
            m = cls._shared[key] = cls(spark, sf_dir)
        return m

    def __init__(self, spark: SparkSession, sf_dir: str, run_ts: dt.datetime = RUN_TS):
        self.spark = spark
        self.tables = DriverTables(spark, sf_dir)
        self.run_ts = run_ts
        self.data_date = run_ts.date()

        self._raw: dict[str, DataFrame] = {}
        self.query_cache: dict[str, DataFrame] = {}
        self.runs: dict[str, object] = {}  # warehouses written by a run that several queries show
        self._staged: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            df = RAW_BUILDERS[name](self.tables)
            if name in OBSERVED_RAW:
                # Landing boundary, as a written raw table is in the pipeline:
                # filters cannot move below ``observe`` (that would change the
                # observed count), so the staging filter reads landed values
                # instead of re-deriving the view's expressions inside it.
                df = df.observe(f"landed_{name}_{id(self):x}", F.count(F.lit(1)).alias("rows"))
            self._raw[name] = df
        return self._raw[name]

    def staged(self, name: str) -> DataFrame:
        if name not in self._staged:
            self._staged[name] = stg.STAGERS[name](self.raw(name))
        return self._staged[name]

    def check_tables(self) -> dict[str, DataFrame]:
        """Inputs of the check catalogue: staged entities, raw views, reference tables."""
        return dict(self._check_tables)

    def reference_tables(self) -> dict[str, DataFrame]:
        """Geography, pairs and intervals that the rules allow, and the sector tree of the smaller parts."""
        bounds = [(k, lo, hi) for k, (lo, hi) in MULTIPLE_BY_DEAL_TYPE.items()]
        pairs = [(k, f) for k, kinds in FINANCING_BY_DEAL_TYPE.items() for f in kinds]
        tree = self.tables.part.filter("p_size <= 45").select(
            F.trim("p_brand").alias("sector"), F.trim("p_type").alias("sub_sector")).distinct()
        return {"nation": self.tables.nation, "ref_sector_tree": tree,
                "ref_multiple_bounds": self.spark.createDataFrame(bounds, "deal_type string, lo double, hi double"),
                "ref_deal_financing": self.spark.createDataFrame(pairs, "deal_type string, financing_type string")}

    @cached_property
    def _check_tables(self) -> dict[str, DataFrame]:
        out = {n: self.staged(n) for n in stg.STAGERS}
        out.update({f"raw_{n}": self.raw(n) for n in RAW_BUILDERS})
        out.update(self.reference_tables())
        return out

    @cached_property
    def quarantine(self) -> DataFrame:
        return stg.transactions_quarantine(self.raw("transactions"))

    @cached_property
    def dim_acquirer(self) -> DataFrame:
        return marts.dimension_rows(self.staged("acquirers"), marts.DIM_ACQUIRER_COLUMNS, self.run_ts)

    @cached_property
    def dim_target(self) -> DataFrame:
        return marts.dimension_rows(self.staged("targets"), marts.DIM_TARGET_COLUMNS, self.run_ts)

    def fct_transactions(self, years: list[int] | None = None) -> DataFrame:
        if years is None:
            return self._fact_all
        return self._fact(years)

    def _fact(self, years: list[int] | None) -> DataFrame:
        return marts.fct_transactions(
            self.staged("transactions"), self.dim_target, self.dim_acquirer,
            self.staged("sector_multiples"), self.staged("acquirer_financials"), self.data_date, years,
            domain=None,
        )

    @cached_property
    def _fact_all(self) -> DataFrame:
        return self._fact(None)

    @cached_property
    def _activity(self) -> DataFrame:
        return marts.dim_acquirer_activity(self.staged("transactions"), self.dim_target,
                                           self.dim_acquirer, self.run_ts)

    def dim_acquirer_activity(self) -> DataFrame:
        return self._activity

    @cached_property
    def _report(self) -> DataFrame:
        return marts.rpt_sector_trend_summary(self.staged("transactions"), self.dim_target, self.data_date)

    def rpt_sector_trend_summary(self) -> DataFrame:
        return self._report

    @cached_property
    def _sequence(self) -> DataFrame:
        return marts.fct_target_deal_sequence(self.staged("transactions"), self.dim_target, self.data_date)

    def fct_target_deal_sequence(self) -> DataFrame:
        return self._sequence
