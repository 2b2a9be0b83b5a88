"""Benchmark the headline queries.

Lands the warehouse from the driver tables at $BENCH_SF_DIR (default
/root/testdata/sf0.1) once, then times each model over the landed tables on
local[$BENCH_CPUS], so that a figure is the model's own and not that of the raw views
derived from the driver tables. "land_and_stage" is the landing itself. Maintenance
queries write real tables on every run. Plans are built anew each time and executed in
full through the ``noop`` sink; the value per query is the median of $BENCH_REPS warm
runs. Prints one JSON line.
"""
from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dealhouse.model import RUN_TS, Model  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from dealhouse.operators import staging as stg  # noqa: E402
from dealhouse.operators.merge import scd1_merge  # noqa: E402
from dealhouse.operators.quality import run_checks  # noqa: E402
from dealhouse.operators.rules import ALL_CHECKS  # noqa: E402
from dealhouse.plans import marts, pipeline  # noqa: E402
from dealhouse.plans.warehouse import Warehouse  # noqa: E402
from dealhouse.queries import REGISTRY  # noqa: E402
from dealhouse.session import local_session, scratch_dir  # noqa: E402


def landed(spark, sf_dir: str) -> tuple[Model, Warehouse]:
    m = Model(spark, sf_dir)
    wh = Warehouse(spark, scratch_dir(spark, "bench"))
    pipeline.land_raw(wh, {n: m.raw(n) for n in stg.STAGERS})
    pipeline.refresh_staging(wh)
    pipeline.refresh_dimensions(wh, RUN_TS)
    return m, wh


def headline(spark, sf_dir: str) -> dict:
    """Name -> a function that builds the query's DataFrame anew."""
    m, wh = landed(spark, sf_dir)

    def read(layer: str, name: str):
        return wh.read(layer, name)

    def checks():
        tables = {n: read("staging", n) for n in stg.STAGERS}
        return run_checks({**tables, **m.reference_tables()}, ALL_CHECKS.checks)

    def fact_write():
        pipeline.refresh_fact(wh, RUN_TS)
        return pipeline.read_fact(wh)

    def merge():
        """All buyers upserted again a day later, every fifth renamed."""
        renamed = read("raw", "acquirers").withColumn("acquirer_name", F.when(
            F.pmod(F.xxhash64("acquirer_id"), F.lit(5)) == 0, F.concat("acquirer_name", F.lit(" Holdings")))
            .otherwise(F.col("acquirer_name")))
        day2 = marts.dimension_rows(stg.stg_acquirers(renamed), marts.DIM_ACQUIRER_COLUMNS, RUN_TS + dt.timedelta(days=1))
        return scd1_merge(dims("dim_acquirer"), day2, ["acquirer_id"], marts.DIM_ACQUIRER_COLUMNS)

    tx, dims = lambda: read("staging", "transactions"), lambda n: read("analytics", n)
    return {
        "stg_transactions": lambda: stg.stg_transactions(read("raw", "transactions")),
        "fct_transactions": lambda: pipeline.fact_source(wh, RUN_TS),
        "dim_acquirer_activity": lambda: marts.dim_acquirer_activity(
            tx(), dims("dim_target"), dims("dim_acquirer"), RUN_TS),
        "rpt_sector_trend_summary": lambda: marts.rpt_sector_trend_summary(tx(), dims("dim_target"), RUN_TS.date()),
        "fct_target_deal_sequence": lambda: marts.fct_target_deal_sequence(tx(), dims("dim_target"), RUN_TS.date()),
        "run_checks": checks,
        "scd1_merge": merge,
        "backfill_partitions": fact_write,
        "land_and_stage": lambda: landed(spark, sf_dir)[1].read("staging", "transactions"),
    }


def run_once(build) -> float:
    t0 = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="dealhouse-bench")
    models = headline(spark, sf_dir)
    names = sys.argv[1:] or list(models)
    out = {}
    for n in names:
        build = models.get(n) or (lambda n=n: REGISTRY[n](spark, sf_dir))
        run_once(build)
        out[n] = round(median(run_once(build) for _ in range(reps)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "sum_of_median_warm_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
