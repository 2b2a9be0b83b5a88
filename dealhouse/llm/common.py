"""Small helpers that several corpus operators share."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dealhouse.session import scratch_dir

# Rows handed to Python at once: long documents must not meet in one large batch.
SLICE_ROWS = 256
ARROW_ROWS = "512"


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now hands rows to Python in batches of ``ARROW_ROWS`` at most.

    Batches lie outside the JVM's heap, on top of it; Spark's default is 10,000 rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` under the session's shared folder and read it back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, columns: list[str], rows: Callable[[Iterator[tuple]], Iterator[tuple]],
             schema: T.StructType) -> DataFrame:
    """Stream ``columns`` of every partition through ``rows`` (tuples in, tuples out).

    Arrow batches are taken apart a few hundred rows at a time, so that memory is
    bounded by the longest texts, not by the partition.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def source() -> Iterator[tuple]:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    yield from zip(*(c.to_pylist() for c in part.columns), strict=True)

        held: list[tuple] = []
        for row in rows(source()):
            held.append(row)
            if len(held) >= SLICE_ROWS:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)

    return bound_batches(df).select(*columns).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)],
        schema=schema)
