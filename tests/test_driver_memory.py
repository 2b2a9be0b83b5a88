"""What passes through the driver is bounded by measured rows, not by the size of compressed files."""
import pytest
from pyspark.sql import functions as F

from dealhouse.session import apply_conf, scratch_dir


@pytest.mark.parametrize("rows, broadcast", [(400_000, False), (2_000, True)])
def test_a_side_is_broadcast_by_its_rows_not_by_its_files(spark, rows, broadcast):
    apply_conf(spark)
    path = scratch_dir(spark, "side")
    # Files of less than a megabyte hold 30 MB of rows.
    spark.range(rows).select(F.concat(F.lit("TGT-"), "id").alias("k"), F.lit("one name of many " * 3).alias("name")).write.parquet(path)
    side = spark.read.parquet(path)
    deals = spark.range(3000).select(F.concat(F.lit("TGT-"), "id").alias("deal_of"), F.lit("d" * 100).alias("text"))
    joined = deals.repartition(4).join(side, F.col("deal_of") == F.col("k"), "left")
    found = joined.filter("name IS NOT NULL AND text IS NOT NULL")
    joined.write.format("noop").mode("overwrite").save()
    assert found.count() == min(rows, 3000)
    joined.collect()
    final = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ("BroadcastHashJoin" in final) == broadcast
