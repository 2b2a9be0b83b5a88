"""Deal warehouse on Spark: layered ingest, typed staging, SCD1 dimensions,
partitioned facts, rollups, timelines and data-quality checks, all expressed
as DataFrame / Spark SQL plans."""

__version__ = "0.1.0"
