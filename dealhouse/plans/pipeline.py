"""Materialise the warehouse layer by layer.

Layers hand over through written tables only (raw -> staging -> analytics),
so each step's lineage starts at the previous layer's files: a lost executor
recomputes from the last written table, never from the sources.

* ``refresh_core``: staging (+ quarantine), SCD1 dimensions, the acquirer
  rollup (SCD1 too), the sector report and the target timeline.
* ``refresh_fact``: the year-partitioned fact; one job for the requested years,
  or for the whole year domain, put in place at once. A requested year without rows
  is cleared; over the whole domain, so is any other partition.
* ``refresh_affected``: only the years that changed inputs reach; ``refresh_affected_marts``: of the
  rollup, the report and the timeline, what changed targets reach.
* ``refresh``: both, returning row counts observed during the writes.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.operators import staging as stg
from dealhouse.operators.merge import assert_unique_keys, ensure_columns, repeats_keys, rows_to_upsert, scd1_merge
from dealhouse.operators.sequence import SMALL
from dealhouse.plans import changelog, marts
from dealhouse.plans.delta import changed_keys, changed_values
from dealhouse.plans.marts import YEAR_DOMAIN
from dealhouse.plans.warehouse import HIDDEN_BUCKET, Warehouse
from dealhouse.session import side_by_side

ENTITIES = list(stg.STAGERS)
# Staged deals lie in folders by year; those outside the fact's domain share one.
YEAR_FOLDER, NO_YEAR = "year_folder", 0


def land_raw(wh: Warehouse, sources: Mapping[str, DataFrame]) -> dict[str, int]:
    """Each source as a raw table; sources do not depend on each other and are written side by side."""
    rows = side_by_side(wh.spark, [lambda n=n, df=df: wh.write("raw", n, df) for n, df in sources.items()])
    return {f"raw.{n}": r for n, r in zip(sources, rows, strict=True)}


def _by_year(deals: DataFrame) -> DataFrame:
    inside = F.col("deal_year").between(YEAR_DOMAIN.start, YEAR_DOMAIN.stop - 1)
    return deals.withColumn(YEAR_FOLDER, F.when(inside, F.col("deal_year")).otherwise(F.lit(NO_YEAR))).hint(
        "rebalance", F.col(YEAR_FOLDER))


def refresh_staging(wh: Warehouse, names: Sequence[str] = ENTITIES) -> dict[str, int]:
    """Staging tables of ``names``; deals landed now are later writes than what the stream sent before."""
    def refresh_one(n: str) -> dict[str, int]:
        raw = wh.read("raw", n)
        if n != "transactions":
            return {f"staging.{n}": wh.write("staging", n, stg.STAGERS[n](raw))}
        staged = stg.STAGERS[n](raw)
        before = changelog.last_batch(wh)
        out = {"staging.transactions": wh.write("staging", n, _by_year(staged), partition_by=[YEAR_FOLDER])}
        changelog.settle(wh, batch_deals(wh), before)
        out["staging.transactions_quarantine"] = wh.write(
            "staging", "transactions_quarantine", stg.transactions_quarantine(raw))
        return out

    return _merged(side_by_side(wh.spark, [lambda n=n: refresh_one(n) for n in names]))


def _merged(counts: Sequence[dict[str, int]]) -> dict[str, int]:
    return {table: rows for part in counts for table, rows in part.items()}


def batch_deals(wh: Warehouse, years: Sequence[int] | None = None, version: int | None = None) -> DataFrame:
    """Clean deals landed by batch; with ``years``, only their folders are read."""
    deals = wh.read("staging", "transactions", version)
    if years is not None:
        deals = deals.filter(F.col(YEAR_FOLDER).isin(list(years)))
    return deals.drop(YEAR_FOLDER)


def staged_transactions(wh: Warehouse, years: Sequence[int] | None = None,
                        before_batch: int | None = None) -> DataFrame:
    """Every clean deal, landed by batch or by stream, in its latest version: the one source of fact and marts.

    ``before_batch``: as it was before that batch of the stream."""
    deals = batch_deals(wh, years)
    changes = changelog.latest(wh, deals.schema, before_batch)
    if changes is None:
        return deals
    newer = changes.filter("NOT deleted").drop("deleted")
    if years is not None:
        newer = newer.filter(F.col("deal_year").isin(list(years)))
    replaced = changes.select(F.col("transaction_id").alias("_replaced"))
    return deals.join(replaced, F.col("transaction_id") == F.col("_replaced"), "left_anti").unionByName(
        newer.select(*deals.columns))


MERGE_BUCKETS = 64


def _in_buckets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(HIDDEN_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(MERGE_BUCKETS)).cast("int"))


def _merge_table(wh: Warehouse, name: str, source: DataFrame, keys: list[str], columns: list[str]) -> int:
    """SCD1 upsert of ``source`` into a table that lies in buckets of its key.

    Only buckets that the source's keys lie in are read, keys and hashes alone, to find what is new or
    changed; only buckets that hold such rows are read whole and rewritten. Without any, the table
    keeps its version."""
    if not wh.exists("analytics", name):
        wh.replace_partitions("analytics", name, _in_buckets(source.select(*columns), keys), HIDDEN_BUCKET, only=True)
        return wh.row_count("analytics", name)
    # The merge reads its source several times: land it once.
    wh.write("staging", f"merge_{name}", _in_buckets(source.select(*columns), keys))
    landed = wh.read("staging", f"merge_{name}")
    assert_unique_keys(landed, keys)

    def held(buckets: list[int]) -> DataFrame:
        return ensure_columns(wh.read_parts("analytics", name, buckets), T.StructType([
            T.StructField("data_date", T.DateType()), T.StructField("row_content_hash", T.StringType())]))

    def buckets_of(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(HIDDEN_BUCKET).distinct().collect())  # MERGE_BUCKETS at most

    dirty = buckets_of(rows_to_upsert(held(buckets_of(landed)), landed, keys))
    if dirty:
        merged = scd1_merge(held(dirty), landed.filter(F.col(HIDDEN_BUCKET).isin(dirty)), keys,
                            [*columns, HIDDEN_BUCKET], check_unique=False)
        wh.replace_partitions("analytics", name, merged, HIDDEN_BUCKET, dirty)
    return wh.row_count("analytics", name)


DIMENSIONS = {"acquirers": ("dim_acquirer", "acquirer_id", marts.DIM_ACQUIRER_COLUMNS),
              "targets": ("dim_target", "target_id", marts.DIM_TARGET_COLUMNS)}


def refresh_dimensions(wh: Warehouse, run_ts: dt.datetime, names: Sequence[str] = tuple(DIMENSIONS)) -> dict[str, int]:
    def refresh_one(n: str) -> dict[str, int]:
        dim, key, columns = DIMENSIONS[n]
        rows = marts.dimension_rows(wh.read("staging", n), columns, run_ts)
        return {f"analytics.{dim}": _merge_table(wh, dim, rows, [key], columns)}

    return _merged(side_by_side(wh.spark, [lambda n=n: refresh_one(n) for n in names if n in DIMENSIONS]))


def refresh_marts(wh: Warehouse, run_ts: dt.datetime) -> dict[str, int]:
    tx = staged_transactions(wh)
    dim_target = wh.read("analytics", "dim_target")
    dim_acquirer = wh.read("analytics", "dim_acquirer")
    built_from = _mart_inputs(wh)
    counts = side_by_side(wh.spark, [
        lambda: merge_activity(wh, marts.dim_acquirer_activity(tx, dim_target, dim_acquirer, run_ts, SMALL)),
        lambda: wh.write("analytics", "rpt_sector_trend_summary",
                         marts.rpt_sector_trend_summary(tx, dim_target, run_ts.date())),
        lambda: write_timeline(wh, marts.fct_target_deal_sequence(tx, dim_target, run_ts.date(), SMALL))])
    _pin_marts(wh, built_from)
    return {f"analytics.{t}": rows for t, rows in zip(MART_TABLES, counts, strict=True)}


MARTS = "marts"
MART_TABLES = ("dim_acquirer_activity", "rpt_sector_trend_summary", "fct_target_deal_sequence")


def _mart_inputs(wh: Warehouse) -> dict[str, int]:
    return {"staging.transactions": wh.current_version("staging", "transactions"),
            "analytics.dim_target": wh.current_version("analytics", "dim_target"), "stream": changelog.last_batch(wh)}


def _mart_tables(wh: Warehouse) -> dict[str, int]:
    return {f"analytics.{t}": wh.current_version("analytics", t) for t in MART_TABLES}


def _pin_marts(wh: Warehouse, built_from: dict[str, int]) -> None:
    wh.pin(MARTS, {**built_from, **_mart_tables(wh)})


def refresh_affected_marts(wh: Warehouse, run_ts: dt.datetime) -> dict[str, int]:
    """The rows that ``refresh_marts`` would leave, made from the models as they are where deals stayed the same.

    The rollup and the report show a target's sector, the timeline its name too, and neither depends
    on buyers but for the names of rollup rows that change. So rollup rows are renewed of buyers whose targets
    changed their sector, the report only if any did, and the timeline keeps its numbering and takes
    the names of now. Other deals, or models that someone else renewed, call for the whole."""
    built, now = wh.pins(MARTS), {**_mart_inputs(wh), **_mart_tables(wh)}
    targets, dim_target = "analytics.dim_target", wh.read("analytics", "dim_target")
    if (any(built.get(t) != v for t, v in now.items() if t != targets)
            or built.get(targets) not in wh.versions("analytics", "dim_target") or repeats_keys(dim_target, ["target_id"])):
        return refresh_marts(wh, run_ts)
    built_from = _mart_inputs(wh)
    tx, report = staged_transactions(wh), wh.read("analytics", "rpt_sector_trend_summary")
    moved = changed_keys(wh.read("analytics", "dim_target", built[targets]), dim_target, ["target_id"], ["sector"])
    if built[targets] != now[targets] and moved.limit(1).count():
        buyers = tx.join(moved, "target_id", "left_semi").select(F.col("acquirer_id").alias("_buyer")).distinct()
        deals = tx.join(buyers, F.col("acquirer_id").eqNullSafe(F.col("_buyer")), "left_semi")
        merge_activity(wh, marts.dim_acquirer_activity(
            deals, dim_target, wh.read("analytics", "dim_acquirer"), run_ts))
        report = marts.rpt_sector_trend_summary(tx, dim_target, run_ts.date())
    # A merge of the whole rollup would refuse buyers that are there twice.
    assert_unique_keys(wh.read("analytics", "dim_acquirer_activity").select("acquirer_id"), ["acquirer_id"])
    timeline = read_timeline(wh)
    timeline = (marts.stamped(timeline, run_ts.date()) if built[targets] == now[targets]
                else marts.renamed_sequence(timeline, dim_target, run_ts.date()))
    out = {
        "analytics.dim_acquirer_activity": wh.row_count("analytics", "dim_acquirer_activity"),
        "analytics.rpt_sector_trend_summary": wh.write(
            "analytics", "rpt_sector_trend_summary",
            marts.stamped(report, run_ts.date()).orderBy(F.col("sector").asc_nulls_last(), F.col("deal_year").asc_nulls_last())),
        "analytics.fct_target_deal_sequence": write_timeline(wh, timeline),
    }
    _pin_marts(wh, built_from)
    return out


def merge_activity(wh: Warehouse, activity: DataFrame) -> int:
    return _merge_table(wh, "dim_acquirer_activity", activity, ["acquirer_id"], marts.ACTIVITY_COLUMNS)


# Folders of the timeline, by hash of the target.
TIMELINE, TARGET_BUCKET, TARGET_BUCKETS = "fct_target_deal_sequence", "target_bucket", 64


def write_timeline(wh: Warehouse, timeline: DataFrame, buckets: Sequence[int] | None = None) -> int:
    """Replace the timeline, or only the targets of ``buckets``."""
    rows = timeline.withColumn(TARGET_BUCKET, F.pmod(F.xxhash64("target_id"), F.lit(TARGET_BUCKETS)).cast("int"))
    wh.replace_partitions("analytics", TIMELINE, rows, TARGET_BUCKET, buckets, only=buckets is None)
    return wh.row_count("analytics", TIMELINE)


def read_timeline(wh: Warehouse) -> DataFrame:
    return wh.read_parts("analytics", TIMELINE).select(*marts.SEQUENCE_COLUMNS)


def refresh_core(wh: Warehouse, run_ts: dt.datetime, names: Sequence[str] = ENTITIES) -> dict[str, int]:
    out = refresh_staging(wh, names)
    out.update(refresh_dimensions(wh, run_ts, names))
    out.update(refresh_marts(wh, run_ts))
    return out


FACT_TABLE = "fct_transactions"
# What the fact is made of: versions of these tables, and the stream's change log.
FACT_INPUTS = (("staging", "transactions"), ("analytics", "dim_target"), ("analytics", "dim_acquirer"),
               ("staging", "sector_multiples"), ("staging", "acquirer_financials"))


def fact_source(wh: Warehouse, run_ts: dt.datetime, years: Sequence[int] | None = None,
                transactions: DataFrame | None = None) -> DataFrame:
    tx = transactions if transactions is not None else staged_transactions(wh, years)
    return marts.fct_transactions(
        tx, wh.read("analytics", "dim_target"), wh.read("analytics", "dim_acquirer"),
        wh.read("staging", "sector_multiples"), wh.read("staging", "acquirer_financials"),
        run_ts.date(), list(years) if years else None)


def input_versions(wh: Warehouse) -> dict[str, int]:
    return {f"{layer}.{name}": wh.current_version(layer, name) for layer, name in FACT_INPUTS}


def refresh_fact(wh: Warehouse, run_ts: dt.datetime, years: Sequence[int] | None = None,
                 transactions: DataFrame | None = None, domain: Sequence[int] = YEAR_DOMAIN) -> dict[str, int]:
    """Replace the fact's ``years``, or, without any, all of ``domain`` and nothing beside it.

    Years outside the domain are an error: no such partition may exist."""
    if outside := sorted(set(years or ()) - set(domain)):
        raise ValueError(f"years outside the fact's domain: {outside}")
    wanted = list(years) if years else list(domain)
    built_from = input_versions(wh)
    src = fact_source(wh, run_ts, wanted, transactions)
    counts = wh.replace_partitions("analytics", FACT_TABLE, src, "deal_year", wanted, only=not years)
    if not years and transactions is None:
        wh.pin(FACT_TABLE, built_from)
        changelog.clear_pending(wh)
    out = {f"analytics.{FACT_TABLE}[{y}]": n for y, n in counts.items() if n or years}
    out[f"analytics.{FACT_TABLE}"] = sum(counts.values())
    return out


# The columns of each side that the fact shows.
SHOWN_OF_TARGET = ("target_name", "sector", "sub_sector", "geography", "ownership_type", "ltm_revenue_mm",
                   "ebitda_margin_pct")
SHOWN_OF_ACQUIRER = ("acquirer_name", "acquirer_type", "primary_sector_focus", "geographic_reach")
SHOWN_OF_BENCHMARK = ("median_ev_ebitda", "median_ev_revenue")
SHOWN_OF_YEAR = ("revenue_mm", "ebitda_mm", "net_debt_mm", "cash_on_hand_mm", "total_assets_mm")


def affected_years(wh: Warehouse) -> list[int] | None:
    """Years of the fact that differ from what its inputs now say; None: all, its last inputs are not known.

    Each input that has a newer version is compared with the one that the fact was built from:
    deals by year, as an order-free sum of row hashes; targets, buyers, benchmarks and financials
    by key, of the columns that the fact shows. Changed keys lead to years by semi joins with the
    deals. What reaches the driver is a list of years."""
    pinned, current = wh.pins(FACT_TABLE), input_versions(wh)
    changed = [t for t, v in current.items() if pinned.get(t) != v]
    if any(pinned.get(t) not in wh.versions(*t.split(".")) for t in current):
        return None

    def old_new(table: str) -> tuple[DataFrame, DataFrame]:
        layer, name = table.split(".")
        return wh.read(layer, name, pinned[table]), wh.read(layer, name)

    deals = staged_transactions(wh).select("target_id", "acquirer_id", "deal_year",
                                           F.year("announce_date").alias("filing_year"))
    parts = []
    if "staging.transactions" in changed:
        old, new = old_new("staging.transactions")
        parts.append(changed_values(old, new, YEAR_FOLDER).select(F.col(YEAR_FOLDER).alias("deal_year")))
    for table, keys, shown, on in (
            ("analytics.dim_target", ["target_id"], SHOWN_OF_TARGET, ["target_id"]),
            ("analytics.dim_acquirer", ["acquirer_id"], SHOWN_OF_ACQUIRER, ["acquirer_id"]),
            ("staging.acquirer_financials", ["acquirer_id", "fiscal_year"], SHOWN_OF_YEAR, ["acquirer_id", "filing_year"])):
        if table in changed:
            keys_changed = changed_keys(*old_new(table), keys, shown).toDF(*on)
            parts.append(deals.join(keys_changed, on, "left_semi").select("deal_year"))
    if "staging.sector_multiples" in changed:
        keys = ["sector", "fiscal_year", "fiscal_quarter"]
        moved = changed_keys(*old_new("staging.sector_multiples"), keys, SHOWN_OF_BENCHMARK).select(
            "sector", F.col("fiscal_year").alias("deal_year")).distinct()
        sectors = wh.read("analytics", "dim_target").select("target_id", "sector")
        parts.append(deals.select("target_id", "deal_year").distinct().join(sectors, "target_id")
                     .join(moved, ["sector", "deal_year"], "left_semi").select("deal_year"))
    years = set(changelog.pending_years(wh))
    if parts:
        found = reduce(DataFrame.unionByName, parts).distinct()
        years |= {r[0] for r in found.filter(F.col("deal_year").isin(list(YEAR_DOMAIN))).collect()}
    return sorted(y for y in years if y in YEAR_DOMAIN)


def refresh_affected(wh: Warehouse, run_ts: dt.datetime) -> dict[str, int]:
    """Bring the fact up to its inputs by replacing only the years that they touch."""
    built_from = input_versions(wh)
    years = affected_years(wh)
    if years is None:
        return refresh_fact(wh, run_ts)
    out = refresh_fact(wh, run_ts, years) if years else {}
    wh.pin(FACT_TABLE, built_from)
    changelog.clear_pending(wh)
    return out


def read_fact(wh: Warehouse) -> DataFrame:
    schema = T.StructType([
        T.StructField(f.name, f.dataType, True) for f in _FACT_TYPES])
    return wh.read_partitioned("analytics", FACT_TABLE, schema, marts.FACT_COLUMNS)


_FACT_TYPES = [
    T.StructField(n, t) for n, t in [
        ("transaction_id", T.StringType()), ("target_id", T.StringType()), ("acquirer_id", T.StringType()),
        ("announce_date", T.DateType()), ("close_date", T.DateType()), ("deal_year", T.IntegerType()),
        ("deal_quarter", T.StringType()), ("deal_type", T.StringType()), ("financing_type", T.StringType()),
        ("deal_size_mm", T.DoubleType()), ("ev_ebitda_multiple", T.DoubleType()),
        ("ev_revenue_multiple", T.DoubleType()), ("synergy_pct_of_deal", T.DoubleType()),
        ("outcome", T.StringType()), ("strategic_rationale_tags", T.StringType()),
        ("num_bidders", T.IntegerType()), ("days_to_close", T.IntegerType()),
        ("target_name", T.StringType()), ("target_sector", T.StringType()),
        ("target_sub_sector", T.StringType()), ("target_geography", T.StringType()),
        ("target_ownership_type", T.StringType()), ("target_ltm_revenue_mm", T.DoubleType()),
        ("target_ebitda_margin_pct", T.DoubleType()), ("acquirer_name", T.StringType()),
        ("acquirer_type", T.StringType()), ("acquirer_sector_focus", T.StringType()),
        ("acquirer_geographic_reach", T.StringType()), ("sector_median_ev_ebitda", T.DoubleType()),
        ("sector_median_ev_revenue", T.DoubleType()), ("ev_ebitda_pct_vs_sector_median", T.DoubleType()),
        ("ev_revenue_pct_vs_sector_median", T.DoubleType()), ("acquirer_fiscal_revenue_mm", T.DoubleType()),
        ("acquirer_fiscal_ebitda_mm", T.DoubleType()), ("acquirer_net_debt_mm", T.DoubleType()),
        ("acquirer_cash_mm", T.DoubleType()), ("acquirer_total_assets_mm", T.DoubleType()),
        ("deal_size_tier", T.StringType()), ("data_date", T.DateType()),
    ]
]


def refresh(wh: Warehouse, sources: Mapping[str, DataFrame] | None, run_ts: dt.datetime,
            years: Sequence[int] | None = None) -> dict[str, int]:
    """Full refresh: land (if sources given), core, then every fact year."""
    out: dict[str, int] = {}
    if sources is not None:
        out.update(land_raw(wh, sources))
    out.update(refresh_core(wh, run_ts))
    out.update(refresh_fact(wh, run_ts, years))
    return out


def land_csv_sources(wh: Warehouse, source_dir: str, names: Sequence[str]) -> dict[str, int]:
    """Land CSV sources: rows of the header's width as raw tables, others as ``<name>_rejected``."""
    from dealhouse.sources.csv import scan_csv_checked, source_path

    out: dict[str, int] = {}
    for n in names:
        seen = Observation(f"{n} of another width")
        good, bad = scan_csv_checked(wh.spark, source_path(wh.spark, source_dir, n), seen=seen)
        out[f"raw.{n}"] = wh.write("raw", n, good)
        if not seen.get.get("rejected"):  # seen by the scan of the others: no second one for none
            bad = bad.limit(0)
        out[f"raw.{n}_rejected"] = wh.write("raw", f"{n}_rejected", bad)
    return out


def incremental_refresh(wh: Warehouse, source_dir: str, run_ts: dt.datetime,
                        years: Sequence[int] | None = None) -> dict[str, int]:
    """Refresh only what the source files that changed since the last successful run touch.

    Changed sources are re-landed and re-staged, their dimensions merged, the models brought up to
    date if deals, targets or buyers changed (``refresh_affected_marts``), and of the fact the years that the changed rows reach
    (``affected_years``) are replaced. Rows that nothing touches keep their stamps. The file
    snapshot is written when the change is detected, before any source is read, and takes effect
    only after the whole refresh succeeded: a failed run is retried, and a file rewritten during
    a run is picked up by the next one. Years still to be replaced after a failure follow from the
    versions that the fact was last built from. Files that belong to no source (such as a stream's
    landing folder) are no change. With ``years``, those are replaced instead.

    A source whose files are gone raises ``MissingSourceError`` on this and every later run
    until it is back; a file with the header alone empties it on purpose."""
    from dealhouse.sources.files import changed_files, file_snapshot

    wh.write("_meta", "file_snapshot_pending", file_snapshot(wh.spark, source_dir))
    snap = wh.read("_meta", "file_snapshot_pending")
    prev = wh.read("_meta", "file_snapshot") if wh.exists("_meta", "file_snapshot") else None
    # One row per changed source table (a handful), not per data row.
    changed = changed_files(snap, prev).filter(F.col("source").isin(ENTITIES)).select("source").distinct().collect()
    names = [n for n in ENTITIES if n in {r["source"] for r in changed}]
    if not names:
        return {}
    out = land_csv_sources(wh, source_dir, names)
    out.update(refresh_staging(wh, names))
    out.update(refresh_dimensions(wh, run_ts, names))
    if {"transactions", "targets", "acquirers"} & set(names):
        out.update(refresh_affected_marts(wh, run_ts))
    out.update(refresh_fact(wh, run_ts, years) if years else refresh_affected(wh, run_ts))
    wh.write("_meta", "file_snapshot", snap)
    return out
