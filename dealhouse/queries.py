"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds the warehouse plan over the driver tables (see
``dealhouse.model``) and returns one output; the oracle SQL for the same name
lives in ``dealhouse.oracle``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dealhouse.model import Model
from dealhouse.session import apply_conf

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str, pure: bool = True):
    """``pure`` queries only define a plan; their DataFrame is reused for the
    same model. Queries that write (pipeline, files, streams) run every call."""
    def deco(fn: Callable[[Model], DataFrame]) -> Callable[[Model], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_conf(spark)
            m = Model.shared(spark, sf_dir)
            if not pure:
                return fn(m)
            if name not in m.query_cache:
                m.query_cache[name] = fn(m)
            return m.query_cache[name]

        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn

    return deco


def _no_load_ts(df: DataFrame) -> DataFrame:
    return df.drop("dw_updated_at")


for _name in ["acquirers", "targets", "transactions", "acquirer_financials", "sector_multiples"]:
    register(f"raw_{_name}")(lambda m, n=_name: m.raw(n))
    register(f"stg_{_name}")(lambda m, n=_name: m.staged(n))

register("transactions_quarantine")(lambda m: m.quarantine)
register("dim_acquirer")(lambda m: _no_load_ts(m.dim_acquirer))
register("dim_target")(lambda m: _no_load_ts(m.dim_target))
register("fct_transactions")(lambda m: m.fct_transactions())
register("dim_acquirer_activity")(lambda m: _no_load_ts(m.dim_acquirer_activity()))
register("rpt_sector_trend_summary")(lambda m: m.rpt_sector_trend_summary())
register("fct_target_deal_sequence")(lambda m: m.fct_target_deal_sequence())

# --- data-quality checks ------------------------------------------------------
from dealhouse.operators.quality import RuleCheck, run_check, run_checks  # noqa: E402
from dealhouse.operators.rules import ALL_CHECKS, null_sentinel_violation  # noqa: E402
from dealhouse.sources.entities import RAW_BUILDERS  # noqa: E402

for _check in ALL_CHECKS.checks:
    register(_check.name)(lambda m, c=_check: run_check(m.check_tables(), c))



@register("chk_null_sentinels")
def _null_sentinels(m: Model) -> DataFrame:
    """Text sentinels ('NULL', 'NaN', ...) in any landed column, per raw table."""
    tables = m.check_tables()
    checks = [
        RuleCheck("chk_null_sentinels", f"raw_{n}",
                  lambda cols=tables[f"raw_{n}"].columns: null_sentinel_violation(cols))
        for n in RAW_BUILDERS
    ]
    return run_checks(tables, checks)

# --- table maintenance, pipeline, sources, streaming ------------------------------
import datetime as _dt  # noqa: E402
import uuid  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from dealhouse.functions.measures import (  # noqa: E402
    avg_from_parts,
    deal_size_tier,
    fixed_sum_exact,
    pct_vs_benchmark,
)
from dealhouse.model import RUN_TS  # noqa: E402
from dealhouse.operators import staging as _stg  # noqa: E402
from dealhouse.operators.merge import ensure_column, scd1_merge  # noqa: E402
from dealhouse.plans import marts as _marts  # noqa: E402
from dealhouse.plans import pipeline as _pl  # noqa: E402
from dealhouse.plans.catalog import CatalogStore  # noqa: E402
from dealhouse.plans.catalog import refresh as _load_catalog  # noqa: E402
from dealhouse.plans.warehouse import Warehouse  # noqa: E402
from dealhouse.session import scratch_dir  # noqa: E402
from dealhouse.sources import csv as _csv  # noqa: E402
from dealhouse.sources.files import changed_files, file_snapshot  # noqa: E402
from dealhouse.plans import changelog as _changelog  # noqa: E402
from dealhouse.streaming.ingest import rejected, stream_ingest, withdraw_deals  # noqa: E402

DAY2_TS = RUN_TS + _dt.timedelta(days=1)


def _key_number(col: str) -> F.Column:
    """The number that a key ends with; NULL without one."""
    return F.regexp_extract(F.trim(F.col(col)), r"([0-9]+)$", 1).try_cast("long")


def _renamed(raw, id_col: str, name_col: str, suffix: str = " Holdings"):
    """Day-2 copy of a raw source: every fifth key renamed."""
    return raw.withColumn(name_col, F.when(_key_number(id_col) % 5 == 0,
                                           F.concat(F.col(name_col), F.lit(suffix)))
                          .otherwise(F.col(name_col)))


@register("scd1_merge")
def _scd1(m: Model) -> DataFrame:
    """Upsert day 2 (renames, every 7th key gone) into day 1 (every 11th key absent)."""
    cols = _marts.DIM_ACQUIRER_COLUMNS
    day1 = _marts.dimension_rows(m.staged("acquirers").filter(_key_number("acquirer_id") % 11 != 0),
                                 cols, RUN_TS)
    day2_src = _stg.stg_acquirers(_renamed(m.raw("acquirers"), "acquirer_id", "acquirer_name"))
    day2 = _marts.dimension_rows(day2_src.filter(_key_number("acquirer_id") % 7 != 0), cols, DAY2_TS)
    return scd1_merge(day1, day2, ["acquirer_id"], cols).drop("dw_updated_at")


@register("scd1_merge_buckets", pure=False)
def _scd1_buckets(m: Model) -> DataFrame:
    """The upsert of ``scd1_merge`` by the warehouse, bucket by bucket."""
    wh, cols = Warehouse(m.spark, scratch_dir(m.spark, "wh")), _marts.DIM_ACQUIRER_COLUMNS
    day1 = m.staged("acquirers").filter(_key_number("acquirer_id") % 11 != 0)
    day2 = _stg.stg_acquirers(_renamed(m.raw("acquirers"), "acquirer_id", "acquirer_name")).filter(
        _key_number("acquirer_id") % 7 != 0)
    for rows, ts in ((day1, RUN_TS), (day2, DAY2_TS)):
        wh.write("staging", "acquirers", rows)
        _pl.refresh_dimensions(wh, ts, ["acquirers"])
    return wh.read("analytics", "dim_acquirer").drop("dw_updated_at")


def _derived(m: Model, name: str) -> DataFrame:
    """A raw source written down, for queries that send it more than once."""
    path = scratch_dir(m.spark, f"derived-{name}")
    _spread(m, name).write.parquet(path)
    return m.spark.read.parquet(path)


def _landed_warehouse(m: Model, transactions=None) -> Warehouse:
    """Raw and staging layers and the dimensions: what the fact needs."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    raw = {n: _spread(m, n) for n in _stg.STAGERS if n != "transactions" or transactions is None}
    if transactions is not None:
        raw["transactions"] = transactions
    _pl.land_raw(wh, raw)
    _pl.refresh_staging(wh)
    _pl.refresh_dimensions(wh, RUN_TS)
    return wh


@register("run_checks", pure=False)
def _run_checks(m: Model) -> DataFrame:
    """The whole catalogue over landed staging tables."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    _pl.land_raw(wh, {n: _spread(m, n) for n in _stg.STAGERS})
    _pl.refresh_staging(wh)
    tables = {n: wh.read("staging", n) for n in _stg.STAGERS}
    return run_checks({**tables, **m.reference_tables()}, ALL_CHECKS.checks)


@register("backfill_partitions", pure=False)
def _backfill(m: Model) -> DataFrame:
    """Every fact year in one job, read back from the partitioned table."""
    wh = _landed_warehouse(m)
    _pl.refresh_fact(wh, RUN_TS)
    return _pl.read_fact(wh)


@register("partition_replace", pure=False)
def _partition_replace(m: Model) -> DataFrame:
    """Backfill, then replace 1996 and 1999 with closed deals only and 1997 with nothing."""
    wh = _landed_warehouse(m)
    _pl.refresh_fact(wh, RUN_TS)
    tx = wh.read("staging", "transactions")
    _pl.refresh_fact(wh, RUN_TS, [1996, 1999], transactions=tx.filter(F.col("outcome").ilike("Closed%")))
    _pl.refresh_fact(wh, RUN_TS, [1997], transactions=tx.filter(F.lit(False)))
    return _pl.read_fact(wh)


def _land_csv_sources(m: Model, src: str, again: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every source as CSV files; those that are sent ``again`` are derived once and handed back."""
    out = {n: _derived(m, n) for n in again}
    for n in _stg.STAGERS:
        _csv.write_csv(out[n] if n in out else _spread(m, n), f"{src}/{n}")
    return out


def _spread(m: Model, name: str) -> DataFrame:
    """A raw source in as many parts as there are cores: one task reads a CSV file, a small table is one part,
    and what is made from a table written in one part is made by one task again."""
    raw = m.raw(name)
    if name not in ("acquirers", "targets"):  # the others have been shuffled
        return raw
    return raw.repartition(m.spark.sparkContext.defaultParallelism, raw.columns[0])


@register("incremental_refresh", pure=False)
def _incremental(m: Model) -> DataFrame:
    """CSV sources -> refresh; targets file rewritten with renames -> second
    refresh picks up only that change; returns dim_target."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    src = scratch_dir(m.spark, "src")
    _land_csv_sources(m, src)
    _pl.incremental_refresh(wh, src, RUN_TS)
    assert _pl.incremental_refresh(wh, src, DAY2_TS) == {}, "unchanged files must not refresh"
    _csv.write_csv(_renamed(_spread(m, "targets"), "target_id", "target_name"), f"{src}/targets")
    _pl.incremental_refresh(wh, src, DAY2_TS)
    return wh.read("analytics", "dim_target").drop("dw_updated_at")


@register("incremental_refresh_fact", pure=False)
def _incremental_fact(m: Model) -> DataFrame:
    """Refresh; the deals of 1995 leave the source, some move out of the year domain or lose
    their year -> the next refresh clears the year and keeps the others out; returns the fact."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    src = scratch_dir(m.spark, "src")
    deals = _land_csv_sources(m, src, ("transactions",))["transactions"]
    _pl.incremental_refresh(wh, src, RUN_TS)
    n = _key_number("transaction_id")
    moved = deals.filter("deal_year <> '1995'").withColumn(
        "deal_year", F.when(n % 10 == 3, "2525").when(n % 10 == 7, "").otherwise(F.col("deal_year")))
    _csv.write_csv(moved, f"{src}/transactions")
    _pl.incremental_refresh(wh, src, RUN_TS)
    return _pl.read_fact(wh)


@register("incremental_refresh_years", pure=False)
def _incremental_years(m: Model) -> DataFrame:
    """Refresh; one target is renamed -> the next refresh replaces the years of its deals alone;
    returns the fact, with the run that made each row and whether its year's files changed."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    src = scratch_dir(m.spark, "src")
    _land_csv_sources(m, src)
    _pl.incremental_refresh(wh, src, RUN_TS)
    before = wh.partition_versions("analytics", _pl.FACT_TABLE)
    last = wh.read("staging", "transactions").agg(F.max(_key_number("target_id"))).first()[0]
    renamed = _spread(m, "targets").withColumn("target_name", F.when(
        _key_number("target_id") == last, F.lit("Renamed")).otherwise(F.col("target_name")))
    _csv.write_csv(renamed, f"{src}/targets")
    _pl.incremental_refresh(wh, src, DAY2_TS)
    replaced = [y for y, v in wh.partition_versions("analytics", _pl.FACT_TABLE).items() if before.get(y) != v]
    return _pl.read_fact(wh).withColumn("replaced", F.col("deal_year").isin(replaced))


@register("incremental_refresh_inputs", pure=False)
def _incremental_inputs(m: Model) -> DataFrame:
    """Refresh; then buyers, benchmarks and financials each change in some rows -> the fact again."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    src = scratch_dir(m.spark, "src")
    sent = _land_csv_sources(m, src, ("sector_multiples", "acquirer_financials"))
    _pl.incremental_refresh(wh, src, RUN_TS)
    _csv.write_csv(_renamed(m.raw("acquirers"), "acquirer_id", "acquirer_name"), f"{src}/acquirers")
    _pl.incremental_refresh(wh, src, RUN_TS)
    _csv.write_csv(sent["sector_multiples"].filter("fiscal_year <> '1995'"), f"{src}/sector_multiples")
    _csv.write_csv(sent["acquirer_financials"].withColumn("revenue_mm", F.when(
        F.col("fiscal_year") == "1997", F.lit("1.5")).otherwise(F.col("revenue_mm"))), f"{src}/acquirer_financials")
    _pl.incremental_refresh(wh, src, RUN_TS)
    return _pl.read_fact(wh)


def _write_lines(lines, path: str) -> None:
    """Lines as they are, below a header: what a CSV writer would not write."""
    lines.write.mode("append").option("header", True).option("quote", "").option("sep", "\u0001").csv(path)


def _parts_of_stream(m: Model) -> dict[str, DataFrame]:
    """Deals landed by batch, sent fresh by stream, corrected once, corrected again, and withdrawn."""
    raw = _derived(m, "transactions")
    n = F.coalesce(_key_number("transaction_id"), F.lit(1))
    lone = n % 499 != 0  # ids that no second deal has
    batch = raw.filter(~(lone & (n % 5 == 0)))
    landed = raw.filter(lone & (n % 5 != 0))
    corrected = landed.filter(n % 45 == 1).withColumns({
        "outcome": F.lit("Corrected"), "deal_year": F.when(n % 2 == 0, F.lit("1994")).otherwise(F.col("deal_year"))})
    return {"batch": batch, "fresh": raw.filter(lone & (n % 5 == 0)), "corrected": corrected,
            "again": corrected.filter(n % 3 == 1).withColumn("outcome", F.lit("Final")),
            "withdrawn": landed.filter(n % 90 == 2).select("transaction_id")}


def _streamed(m: Model) -> Warehouse:
    """Most deals arrive by batch, some by stream: fresh ones, every tenth a correction of a batch
    deal, some corrected again, some withdrawn; files with their columns in another order, rows
    with line ends in a field, and rows and files that are set apart. One run in three change
    batches serves the queries that show what it left, in the fact and in each model."""
    if "streamed" in m.runs:
        return m.runs["streamed"]
    parts = _parts_of_stream(m)
    wh = _landed_warehouse(m, parts["batch"])
    _pl.refresh_fact(wh, RUN_TS)
    src, ckpt = scratch_dir(m.spark, "stream-src"), scratch_dir(m.spark, "stream-ckpt")
    n = _key_number("transaction_id")
    fresh = parts["fresh"].withColumn("strategic_rationale_tags", F.when(
        n % 15 == 0, F.lit("Scale\n\"Synergy\"")).otherwise(F.col("strategic_rationale_tags")))
    _csv.write_csv(fresh.filter(n % 10 == 0), f"{src}/in-order")
    _csv.write_csv(fresh.filter(n % 10 != 0).select(*reversed(fresh.columns)), f"{src}/other-order")
    broken = parts["batch"].filter(_key_number("transaction_id") % 8 == 1)
    _write_lines(broken.select(F.concat(F.to_csv(F.struct(*broken.columns)), F.lit(",more")).alias(
        ",".join(_stg.TRANSACTION_COLUMNS))), f"{src}/over-wide")
    _csv.write_csv(broken.withColumnRenamed("outcome", "result"), f"{src}/other-header")
    _csv.write_csv(parts["corrected"], f"{src}/corrected")
    # Sources come as many files, which tasks read side by side; the number of batches stays.
    files = {d: sum(f.endswith(".csv") for f in wh.list_dir(f"{src}/{d}")) for d in wh.list_dir(src)}
    sent_fresh = files["in-order"] + files["other-order"]
    stream_ingest(wh, f"{src}/*", ckpt, RUN_TS, max_files_per_trigger=max(sent_fresh, sum(files.values()) - sent_fresh))
    _csv.write_csv(parts["again"], f"{src}/again")
    withdraw_deals(wh, parts["withdrawn"], f"{src}/gone")
    stream_ingest(wh, f"{src}/*", ckpt, RUN_TS)
    m.runs["streamed"] = wh
    return wh


@register("stream_ingest", pure=False)
def _stream(m: Model) -> DataFrame:
    """The fact after batch and stream."""
    return _pl.read_fact(_streamed(m))


@register("stream_activity", pure=False)
def _stream_activity(m: Model) -> DataFrame:
    """The rollup that the stream kept by change, of buyers that still have deals."""
    wh = _streamed(m)
    buyers = _pl.staged_transactions(wh).select(F.col("acquirer_id").alias("_a")).distinct()
    rows = wh.read("analytics", "dim_acquirer_activity")
    return _no_load_ts(rows.join(buyers, F.col("acquirer_id").eqNullSafe(F.col("_a")), "left_semi"))


@register("stream_timeline", pure=False)
def _stream_timeline(m: Model) -> DataFrame:
    """The timeline that the stream kept by change."""
    return _pl.read_timeline(_streamed(m))


@register("stream_report", pure=False)
def _stream_report(m: Model) -> DataFrame:
    """The sector report that the stream kept by change."""
    return _streamed(m).read("analytics", "rpt_sector_trend_summary")


@register("stream_rejected", pure=False)
def _stream_rejected(m: Model) -> DataFrame:
    """Files with over-wide and short rows and one with another header: rows set apart, by reason, and
    those that reached the change log."""
    raw = _derived(m, "transactions").filter(F.coalesce(_key_number("transaction_id") % 499 != 0, F.lit(False)))
    wh = _landed_warehouse(m, raw.limit(0))
    src = scratch_dir(m.spark, "stream-src")
    n, head = _key_number("transaction_id"), ",".join(_stg.TRANSACTION_COLUMNS)
    line = F.to_csv(F.struct(*raw.columns))
    shaped = (F.when(n % 7 == 1, F.concat(line, F.lit(",more"))).when(n % 7 == 2, F.substring_index(line, ",", 2))
              .otherwise(line))
    _write_lines(raw.filter(n % 3 != 0).select(shaped.alias(head)), f"{src}/rows")
    _csv.write_csv(raw.filter(n % 3 == 0).withColumnRenamed("outcome", "result"), f"{src}/other-header")
    stream_ingest(wh, f"{src}/*", scratch_dir(m.spark, "stream-ckpt"), RUN_TS)
    logged = _changelog.latest(wh, _pl.batch_deals(wh).schema)
    return rejected(wh).groupBy("reason").agg(F.count(F.lit(1)).alias("row_count")).unionByName(
        logged.agg(F.lit("logged").alias("reason"), F.count(F.lit(1)).alias("row_count")))


def _odd_text(raw, name: str):
    """A raw source with quotes, commas and line ends in the second column of some rows."""
    key, text = raw.columns[0], raw.columns[1]
    odd = F.concat(F.lit('say "hi",\n'), F.col(text))
    return raw.withColumn(text, F.when(F.coalesce(_key_number(key) % 19 == 0, F.lit(False)), odd).otherwise(F.col(text)))


@register("scan_csv_strings", pure=False)
def _scan(m: Model) -> DataFrame:
    """All five sources written as CSV, some fields with quotes and line ends, and scanned back
    as text: a row per source row with its key and a hash of all its fields."""
    parts = []
    for n in _stg.STAGERS:
        path = scratch_dir(m.spark, f"csv-{n}")
        _csv.write_csv(_odd_text(m.raw(n), n), path)
        back = _csv.scan_csv_strings(m.spark, path)
        fields = [F.coalesce(F.col(c), F.lit("<null>")) for c in back.columns]
        parts.append(back.select(F.lit(n).alias("source"), F.col(back.columns[0]).alias("key"),
                                 F.md5(F.concat_ws("|", *fields)).alias("fields_md5")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("export_csv_with_manifest", pure=False)
def _export(m: Model) -> DataFrame:
    """The three models as CSV, with the rows of each; the staged deals behind them are derived once."""
    out, path = scratch_dir(m.spark, "export"), scratch_dir(m.spark, "export-deals")
    m.staged("transactions").write.parquet(path)
    deals = m.spark.read.parquet(path)
    _csv.export_csv_with_manifest(m.spark, {
        "fct_transactions": _marts.fct_transactions(
            deals, m.dim_target, m.dim_acquirer, m.staged("sector_multiples"), m.staged("acquirer_financials"),
            m.data_date, domain=None),
        "dim_acquirer_activity": _marts.dim_acquirer_activity(deals, m.dim_target, m.dim_acquirer, m.run_ts),
        "rpt_sector_trend_summary": _marts.rpt_sector_trend_summary(deals, m.dim_target, m.data_date),
    }, out)
    return _csv.read_manifest(m.spark, out)


@register("row_count_metrics", pure=False)
def _row_counts(m: Model) -> DataFrame:
    """Rows of every table of a refreshed warehouse, as observed when each was written: no second scan."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    _pl.refresh(wh, {n: m.raw(n) for n in _stg.STAGERS}, RUN_TS)
    counts = [(f"{layer}.{t}", wh.row_count(layer, t)) for layer in ("raw", "staging", "analytics")
              for t in wh.list_dir(f"{wh.root}/{layer}")]
    return m.spark.createDataFrame(counts, "table_name string, row_count bigint")


@register("changed_files", pure=False)
def _changed(m: Model) -> DataFrame:
    """Snapshot, rewrite one source, add one, remove one: the diff names them, with the rows
    that each now has."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    src = scratch_dir(m.spark, "src")
    _land_csv_sources(m, src)
    wh.write("_meta", "file_snapshot", file_snapshot(m.spark, src))
    before = wh.read("_meta", "file_snapshot")
    _csv.write_csv(_renamed(m.raw("targets"), "target_id", "target_name"), f"{src}/targets")
    _csv.write_csv(m.raw("acquirers"), f"{src}/acquirers_extra")
    wh.delete_path(f"{src}/sector_multiples")
    wh.write("_meta", "file_snapshot", file_snapshot(m.spark, src))
    changed = changed_files(wh.read("_meta", "file_snapshot"), before).select("source", "status")
    # A rewritten folder has new part files and lacks its old ones: the source is modified.
    status = F.when(F.count_distinct("status") > 1, "modified").otherwise(F.min("status"))
    rows = [_csv.scan_csv_strings(m.spark, f"{src}/{n}").agg(F.lit(n).alias("n"), F.count(F.lit(1)).alias("row_count"))
            for n in ("targets", "acquirers_extra")]
    return (changed.groupBy("source").agg(status.alias("status"))
            .join(rows[0].unionByName(rows[1]), F.col("source") == F.col("n"), "left")
            .select("source", "status", F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")))


@register("ensure_column", pure=False)
def _ensure(m: Model) -> DataFrame:
    """A dimension version written before ``data_date`` existed, read back with
    the column added (NULL), as the merge path does before upserting."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    wh.write("analytics", "dim_target", m.dim_target.drop("data_date", "dw_updated_at"))
    old = wh.read("analytics", "dim_target")
    return ensure_column(old, "data_date", "date")


@register("reset_layers", pure=False)
def _reset(m: Model) -> DataFrame:
    """Load all layers, drop them: rows that each layer held, and tables that are left."""
    wh = Warehouse(m.spark, scratch_dir(m.spark, "wh"))
    _pl.land_raw(wh, {n: m.raw(n) for n in _stg.STAGERS})
    _pl.refresh_core(wh, RUN_TS)
    layers = ("raw", "staging", "analytics")
    held = {x: sum(wh.row_count(x, t) for t in wh.list_dir(f"{wh.root}/{x}")) for x in layers}
    dropped = wh.reset_layers()
    rows = [(x, held[x], x in dropped, len(wh.list_dir(f"{wh.root}/{x}"))) for x in layers]
    return m.spark.createDataFrame(rows, "layer string, rows_dropped bigint, dropped boolean, tables_left int")


@register("catalog_sql", pure=False)
def _catalog_sql(m: Model) -> DataFrame:
    """All layers loaded twice as catalog tables, the second time with 1997 and 1998 replaced by what day 2
    renamed; then plain SQL by table name."""
    prefix = f"dealhouse_{uuid.uuid4().hex[:8]}_"
    store = CatalogStore(m.spark, scratch_dir(m.spark, "catalog"), prefix)
    raw = {n: _derived(m, n) for n in _stg.STAGERS}  # loaded twice
    _load_catalog(store, raw, RUN_TS)
    _load_catalog(store, {**raw, "targets": _renamed(raw["targets"], "target_id", "target_name")}, RUN_TS, [1997, 1998])
    return m.spark.sql(f"""
        SELECT f.deal_year, count(*) AS deals, count_if(f.target_name LIKE '% Holdings') AS renamed_deals,
               count(a.acquirer_id) AS known_buyers, max(s.deal_sequence_number) AS longest
        FROM {prefix}analytics.fct_transactions f
        LEFT JOIN {prefix}analytics.dim_acquirer_activity a ON a.acquirer_id = f.acquirer_id
        LEFT JOIN (SELECT transaction_id, max(deal_sequence_number) AS deal_sequence_number
                   FROM {prefix}analytics.fct_target_deal_sequence GROUP BY transaction_id) s
          ON s.transaction_id = f.transaction_id
        GROUP BY f.deal_year""")

# --- operator-level views (joins, aggregates, windows, scalar rules): each its own small plan ------


def _with_target(m: Model, *columns: str):
    tg = m.dim_target.select(F.col("target_id").alias("_tg"), *columns)
    return m.staged("transactions").join(tg, F.col("_tg") == F.col("target_id"), "left")


def _with_benchmark(m: Model):
    sm = m.staged("sector_multiples").select(
        F.col("sector").alias("_sector"), F.col("fiscal_year").alias("_year"), F.col("fiscal_quarter").alias("_quarter"),
        F.col("median_ev_ebitda").alias("sector_median_ev_ebitda"),
        F.col("median_ev_revenue").alias("sector_median_ev_revenue"))
    return _with_target(m, F.col("sector").alias("target_sector")).join(
        sm, (F.col("_sector") == F.col("target_sector")) & (F.col("_year") == F.col("deal_year"))
        & (F.col("_quarter") == F.col("deal_quarter")), "left")


@register("join_left_single")
def _j_single(m: Model) -> DataFrame:
    return _with_target(m, "target_name", F.col("sector").alias("target_sector")).select(
        "transaction_id", "target_id", "target_name", "target_sector")


@register("join_left_composite")
def _j_composite(m: Model) -> DataFrame:
    return _with_benchmark(m).select("transaction_id", "target_sector", "deal_year", "deal_quarter",
                                     "sector_median_ev_ebitda", "sector_median_ev_revenue")


@register("join_left_expr_key")
def _j_expr(m: Model) -> DataFrame:
    af = m.staged("acquirer_financials").select(
        F.col("acquirer_id").alias("_af"), "fiscal_year", F.col("revenue_mm").alias("acquirer_fiscal_revenue_mm"),
        F.col("net_debt_mm").alias("acquirer_net_debt_mm"))
    return m.staged("transactions").join(
        af, (F.col("_af") == F.col("acquirer_id")) & (F.col("fiscal_year") == F.year("announce_date")), "left").select(
        "transaction_id", "acquirer_id", "announce_date", "acquirer_fiscal_revenue_mm", "acquirer_net_debt_mm")


@register("join_inner")
def _j_inner(m: Model) -> DataFrame:
    tx = m.staged("transactions")
    tg = m.dim_target.select(F.col("target_id").alias("_tg"), "sector")
    return tx.join(tg, F.col("_tg") == F.col("target_id"), "inner").select("transaction_id", "target_id", "sector")


@register("anti_not_exists")
def _anti(m: Model) -> DataFrame:
    """Deals whose acquirer is not in staging (NULL acquirer counts as orphan)."""
    acq = m.staged("acquirers").select(F.col("acquirer_id").alias("_a"))
    return (m.staged("transactions").join(acq, F.col("acquirer_id") == F.col("_a"), "left_anti")
            .select("transaction_id", "acquirer_id"))


@register("agg_count_sum_avg_min_max")
def _agg_basic(m: Model) -> DataFrame:
    return m.staged("transactions").groupBy("acquirer_id").agg(
        F.count(F.lit(1)).alias("deal_count"),
        fixed_sum_exact("deal_size_mm").cast("double").alias("total_deal_volume_mm"),
        avg_from_parts(fixed_sum_exact("ev_ebitda_multiple"), F.count("ev_ebitda_multiple")).alias("avg_ev_ebitda_multiple"),
        F.min("announce_date").alias("first_transaction_date"),
        F.max("announce_date").alias("most_recent_transaction_date"))


@register("agg_count_distinct")
def _agg_distinct(m: Model) -> DataFrame:
    return _with_target(m, F.col("sector").alias("target_sector")).groupBy("acquirer_id").agg(
        F.count_distinct("target_sector").alias("distinct_target_sectors"))


@register("agg_string_concat")
def _agg_concat(m: Model) -> DataFrame:
    return m.dim_acquirer_activity().select("acquirer_id", "deal_types_observed", "sectors_touched")


@register("agg_span_ratio")
def _agg_span(m: Model) -> DataFrame:
    g = m.staged("transactions").groupBy("acquirer_id").agg(
        F.count(F.lit(1)).alias("deal_count"), (F.max("deal_year") - F.min("deal_year") + 1).alias("span"))
    span = F.when(F.col("acquirer_id").isNotNull(), F.nullif("span", F.lit(0)))
    return g.select("acquirer_id", "deal_count", (F.col("deal_count").cast("double") / span).alias("avg_deals_per_active_year"))


@register("agg_conditional_sum")
def _agg_cond(m: Model) -> DataFrame:
    return m.rpt_sector_trend_summary().select("sector", "deal_year", "closed_deal_count", "pending_deal_count")


@register("agg_having_dupes")
def _agg_dupes(m: Model) -> DataFrame:
    """Repeated transaction ids and how often each occurs."""
    return (m.staged("transactions").groupBy("transaction_id").agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


@register("win_row_number")
def _w_rn(m: Model) -> DataFrame:
    return m.fct_target_deal_sequence().select("target_id", "transaction_id", "acquirer_id",
                                               "announce_date", "deal_sequence_number")


@register("win_lag")
def _w_lag(m: Model) -> DataFrame:
    return m.fct_target_deal_sequence().select(
        "target_id", "deal_sequence_number", "prior_transaction_id", "prior_announce_date", "prior_close_date",
        "prior_outcome", "prior_deal_size_mm", "prior_ev_ebitda_multiple", "prior_acquirer_id")


@register("win_deltas")
def _w_delta(m: Model) -> DataFrame:
    return m.fct_target_deal_sequence().select(
        "target_id", "deal_sequence_number", "days_since_prior_announce", "deal_size_mm_delta_vs_prior",
        "ev_ebitda_multiple_delta_vs_prior", "same_acquirer_as_prior")


@register("deal_size_tier")
def _tier(m: Model) -> DataFrame:
    return m.staged("transactions").select("transaction_id", "deal_size_mm", deal_size_tier("deal_size_mm").alias("deal_size_tier"))


@register("pct_vs_benchmark")
def _pct(m: Model) -> DataFrame:
    return _with_benchmark(m).select(
        "transaction_id",
        pct_vs_benchmark("ev_ebitda_multiple", "sector_median_ev_ebitda").alias("ev_ebitda_pct_vs_sector_median"),
        pct_vs_benchmark("ev_revenue_multiple", "sector_median_ev_revenue").alias("ev_revenue_pct_vs_sector_median"))


@register("row_content_hash")
def _hash(m: Model) -> DataFrame:
    """Content hashes of both hashed entities."""
    acq = m.staged("acquirers").select(F.col("acquirer_id").alias("entity_id"), "row_content_hash")
    return acq.unionByName(m.staged("targets").select(F.col("target_id").alias("entity_id"), "row_content_hash"))


@register("quarantine_preview")
def _preview(m: Model) -> DataFrame:
    """First 20 quarantined rows in a total order (a top-k, not a full sort)."""
    q = m.quarantine
    return q.orderBy(*[F.col(c).asc_nulls_last() for c in ["quarantine_reason", *q.columns[:-1]]]).limit(20)


@register("chk_csv_width", pure=False)
def _csv_width(m: Model) -> DataFrame:
    """Field-count check over all five landed sources, some of whose files have rows with a field
    too many and some with one too few."""
    parts = []
    for n in _stg.STAGERS:
        path, raw = scratch_dir(m.spark, f"csv-{n}"), _derived(m, n)  # sent in three parts
        k = F.coalesce(_key_number(raw.columns[0]), F.lit(1))
        _csv.write_csv(raw.filter((k % 23 != 0) & (k % 29 != 0)), path)
        _csv.write_csv(raw.filter(k % 23 == 0).withColumn("one_more", F.lit("x")), path, mode="append")
        _csv.write_csv(raw.filter((k % 23 != 0) & (k % 29 == 0)).drop(raw.columns[-1]), path, mode="append")
        bad = _csv.csv_width_violations(m.spark, path, raw.columns)
        # Spark rejects CSV queries that read only the corrupt-record column, so the
        # counted expression also reads a data column (and cannot be folded away).
        count = F.count(F.coalesce(F.col(_csv.CORRUPT_COLUMN), F.col(bad.columns[0])))
        parts.append(bad.agg(F.lit("chk_csv_width").alias("check_name"), F.lit(f"raw_{n}").alias("table_name"),
                             F.lit("ERROR").alias("severity"), count.alias("violations"), (count == 0).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- checks against what a sector or a country has --------------------------------
from dealhouse.operators import bands as _bands  # noqa: E402
from dealhouse.operators import geography as _geo  # noqa: E402

_REVENUE_PER_HEAD = ("ltm_revenue_mm", "employee_count")


@register("size_vs_headcount_by_sector")
def _size_by_sector(m: Model) -> DataFrame:
    """Targets below and above the band of revenue per head that their sector's exact quartiles span."""
    return _bands.sides_by_group(m.staged("targets"), "sector", _bands.per_head(*_REVENUE_PER_HEAD))


@register("size_vs_headcount_sketch")
def _size_sketch(m: Model) -> DataFrame:
    """The same quartiles from mergeable sketches, held against exact ranks."""
    return _bands.sketch_ranks(m.staged("targets"), "sector", _bands.per_head(*_REVENUE_PER_HEAD))


@register("geography_consistency")
def _geography(m: Model) -> DataFrame:
    """Headquarters as addresses (some in another order, short of a part, or with a region of another
    country) against the hierarchy of regions and nations."""
    t, k = m.tables, F.col("c_custkey")
    hierarchy = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("country"), F.col("n_name").alias("subdivision"), "n_nationkey", "n_regionkey")
    other = t.region.select(F.col("r_regionkey").alias("_next"), F.col("r_name").alias("other"))
    places = hierarchy.join(other, F.col("_next") == (F.col("n_regionkey") + 1) % 5)
    text = (F.when(k % 29 == 0, F.lit(None)).when(k % 23 == 0, F.lit(" , ;"))
            .when(k % 19 == 0, F.concat("subdivision", F.lit(", Atlantis")))
            .when(k % 17 == 0, F.concat(F.lit("Atlantis; "), F.col("country")))
            .when(k % 13 == 0, F.concat("subdivision", F.lit(", "), "other"))
            .when(k % 11 == 0, F.col("subdivision"))
            .when(k % 7 == 0, F.concat(F.lower("country"), F.lit(" / "), F.lower("subdivision")))
            .otherwise(F.concat("subdivision", F.lit(","), "country")))
    offices = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(text.alias("headquarters"))
    verdicts = _geo.address_verdicts(offices, "headquarters", hierarchy.select("country", "subdivision"))
    return verdicts.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("addresses"), F.sum("rows").alias("acquirers"))
