"""The stream's keyed change log: the last writer of a deal wins.

Every micro-batch of the stream adds a folder with one row per transaction id: the deal's
new version, or a tombstone (``deleted``) for a deal that was withdrawn. Of several writes the
one with the highest batch id counts, in a batch the last by file name and row, and a version
by stream replaces whatever the batch landing holds under that id. A later batch landing is a
later write: ``settle`` then takes what the landing also has out of the log. Folders are
compacted into a base table that says, beside its row count, through which batch it goes.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.plans.warehouse import Warehouse

LOG, BASE = "transactions_stream", "transactions_stream_base"
BATCH, DELETED = "through_batch", "deleted"
PENDING = "pending_years"
MAX_BATCHES = 32


def batch_path(wh: Warehouse, batch_id: int) -> str:
    return f"{wh.table_path('staging', LOG)}/batch={batch_id:09d}"


def batches(wh: Warehouse) -> list[int]:
    folders = wh.list_dir(wh.table_path("staging", LOG))
    return sorted(int(f.removeprefix("batch=")) for f in folders
                  if f.startswith("batch=") and wh.exists_path(f"{wh.table_path('staging', LOG)}/{f}/_SUCCESS"))


def last_batch(wh: Warehouse) -> int:
    return max([wh.meta("staging", BASE).get(BATCH, -1), *batches(wh)])


def _log_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(DELETED, T.BooleanType()), T.StructField(BATCH, T.LongType())])


def log(wh: Warehouse, schema: T.StructType, before_batch: int | None = None) -> DataFrame | None:
    """All rows of the log, with the batch that each came in; None if there are none.

    ``before_batch`` leaves out that batch and later ones, but not what is compacted."""
    through = wh.meta("staging", BASE).get(BATCH, -1)
    paths = [batch_path(wh, b) for b in batches(wh) if b > through and (before_batch is None or b < before_batch)]
    parts = [wh.read("staging", BASE)] if wh.exists("staging", BASE) else []
    if paths:
        parts.append(wh.spark.read.schema(_log_schema(schema)).parquet(*paths))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]) if parts else None


def _last(rows: DataFrame, order: Column) -> DataFrame:
    """Per transaction id the row with the greatest ``order``; combined before the shuffle, so a hot id is one row."""
    return rows.groupBy("transaction_id").agg(F.max_by(F.struct(*rows.columns), order).alias("row")).select("row.*")


def latest(wh: Warehouse, schema: T.StructType, before_batch: int | None = None) -> DataFrame | None:
    """One row per id that the log holds: the deal's last version, or ``deleted``."""
    rows = log(wh, schema, before_batch)
    return None if rows is None else _last(rows, F.col(BATCH)).drop(BATCH)


def append(wh: Warehouse, deals: DataFrame, withdrawn: DataFrame, batch_id: int, order: tuple[str, ...]) -> DataFrame:
    """Write the batch's folder from its staged ``deals`` and ``withdrawn`` ids, and read it back.

    ``order`` names the columns that tell the later of two rows of one batch. A batch that is
    run again overwrites its folder."""
    schema = T.StructType([f for f in deals.schema if f.name not in order])
    gone = withdrawn.select(
        "transaction_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != "transaction_id"],
        F.lit(True).alias(DELETED), *order)
    rows = deals.withColumn(DELETED, F.lit(False)).unionByName(gone)
    last = _last(rows, F.struct(*order)).drop(*order).withColumn(BATCH, F.lit(batch_id).cast("long"))
    last.write.mode("overwrite").parquet(batch_path(wh, batch_id))
    return wh.spark.read.schema(_log_schema(schema)).parquet(batch_path(wh, batch_id))


def compact(wh: Warehouse, schema: T.StructType, max_batches: int = MAX_BATCHES) -> None:
    """Keep the last version of every id in one table once there are more than ``max_batches`` folders.

    The table says through which batch it goes, so a crash before the folders are deleted
    counts no row twice."""
    done = batches(wh)
    if len(done) > max_batches:
        _rewrite(wh, _last(log(wh, schema), F.col(BATCH)), done[-1])


def _rewrite(wh: Warehouse, rows: DataFrame, through: int) -> None:
    wh.write("staging", BASE, rows, meta={BATCH: through})
    for b in batches(wh):
        if b <= through:
            wh.delete_path(batch_path(wh, b))


def settle(wh: Warehouse, landed: DataFrame, through: int) -> None:
    """Take changes up to batch ``through`` out of the log where ``landed``, a later write, has the id.

    The fact's years that this touches are noted first, so that a crash cannot lose them.
    Tombstones of ids that the landing has no longer go as well."""
    rows = log(wh, landed.schema)
    if rows is None:
        return
    ids = landed.select(F.col("transaction_id").alias("_id"), F.col("deal_year").alias("_year"))
    old = rows.filter(F.col(BATCH) <= through).join(ids, F.col("transaction_id") == F.col("_id"))
    years = old.select(F.explode(F.array("deal_year", "_year")).alias("y")).filter("y is not null").distinct()
    wh.note(PENDING, {"years": sorted({*pending_years(wh), *(r[0] for r in years.collect())})})
    kept = _last(rows.filter(F.col(BATCH) <= through), F.col(BATCH)).filter(f"NOT {DELETED}").join(
        ids.select("_id"), F.col("transaction_id") == F.col("_id"), "left_anti")
    _rewrite(wh, kept, through)  # folders of later batches stay and still count


def pending_years(wh: Warehouse) -> list[int]:
    """Years of the fact that a settled change touches and that are not replaced yet."""
    return wh.noted(PENDING).get("years", [])


def clear_pending(wh: Warehouse) -> None:
    if pending_years(wh):
        wh.note(PENDING, {"years": []})
