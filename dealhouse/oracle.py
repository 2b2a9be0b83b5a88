"""Oracle SQL (DuckDB dialect) for every registered query.

Written from the rules, not from the Spark plans. Only the driver's parquet
tables exist as views, so each query repeats the entity and staging steps it
needs as CTEs. Staging is spelled out of a table of column rules; the deal
timeline pairs each deal with the one numbered before it; the rollup walks an
ordered list of an acquirer's deals. Conventions shared with the Spark side: sums
are exact DECIMAL(38,6), averages are that sum over the non-null count, doubles
enter hashes as DECIMAL(38,6) text, every ORDER BY spells out NULLS LAST.
"""
from __future__ import annotations

DATA_DATE_SQL = "DATE '2025-01-01'"

RAW = {
    "raw_transactions": """
raw_transactions AS (
  SELECT
    CASE WHEN o.o_orderkey % 211 = 0 THEN '  '
         WHEN o.o_orderkey % 13 = 0 THEN ' txn-' || CAST(o.o_orderkey AS VARCHAR) || ' '
         WHEN o.o_orderkey % 499 = 1 THEN 'TXN-' || CAST(o.o_orderkey - 1 AS VARCHAR)
         ELSE 'TXN-' || CAST(o.o_orderkey AS VARCHAR) END AS transaction_id,
    CASE WHEN o.o_orderkey % 307 = 0 THEN 'TGT-MISSING'
         ELSE 'TGT-' || CAST(l.lead_part AS VARCHAR) END AS target_id,
    CASE WHEN o.o_orderkey % 401 = 0 THEN 'ACQ-MISSING'
         ELSE 'ACQ-' || CAST(o.o_custkey AS VARCHAR) END AS acquirer_id,
    CASE WHEN o.o_orderkey % 997 = 0 THEN '2020'
         WHEN o.o_orderkey % 7 = 0 THEN replace(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR), '-', '/')
         ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS announce_date,
    CASE WHEN o.o_orderstatus = 'F' THEN CAST(CAST(l.last_ship AS DATE) AS VARCHAR) ELSE '' END AS close_date,
    CASE WHEN o.o_orderkey % 223 = 5 THEN '2525' WHEN o.o_orderkey % 227 = 5 THEN ''
         ELSE CAST(year(o.o_orderdate) AS VARCHAR) END AS deal_year,
    'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS deal_quarter,
    o.o_orderpriority AS deal_type,
    l.rf AS financing_type,
    CASE WHEN o.o_orderkey % 97 = 0 THEN '-5.5'
         WHEN o.o_orderkey % 101 = 0 THEN 'n/a'
         ELSE CAST(CAST(o.o_totalprice / 100 AS DECIMAL(18,1)) AS VARCHAR) END AS deal_size_mm,
    CAST(CAST(CAST(l.ext AS DOUBLE) / CAST(l.qty AS DOUBLE) / 200 AS DECIMAL(18,1)) AS VARCHAR) AS ev_ebitda_multiple,
    CAST(CAST(CAST(l.ext AS DOUBLE) / CAST(l.qty AS DOUBLE) / 800 AS DECIMAL(18,2)) AS VARCHAR) AS ev_revenue_multiple,
    CAST(CAST(l.disc * 100 AS DECIMAL(18,1)) AS VARCHAR) AS synergy_pct_of_deal,
    CASE WHEN o.o_orderstatus = 'F' THEN (CASE WHEN o.o_orderkey % 2 = 0 THEN 'Closed' ELSE ' closed ' END)
         WHEN o.o_orderstatus = 'P' THEN 'Pending'
         ELSE 'Rumored' END AS outcome,
    'Scale;Synergy' AS strategic_rationale_tags,
    CASE WHEN o.o_orderkey % 89 = 0 THEN '3.7' ELSE CAST(l.bidders AS VARCHAR) END AS num_bidders,
    CASE WHEN o.o_orderkey % 83 = 0 THEN NULL
         WHEN o.o_orderstatus = 'F'
           THEN CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.last_ship AS DATE)) AS VARCHAR)
    END AS days_to_close
  FROM orders o
  LEFT JOIN (
    SELECT l_orderkey,
           min(l_partkey) AS lead_part,
           max(l_shipdate) AS last_ship,
           sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext,
           sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty,
           max(l_discount) AS disc,
           count(DISTINCT l_suppkey) AS bidders,
           chr(min(ascii(l_returnflag))) AS rf
    FROM lineitem GROUP BY l_orderkey
  ) l ON l.l_orderkey = o.o_orderkey
)""",
    "raw_acquirers": """
raw_acquirers AS (
  SELECT
    CASE WHEN c.c_custkey % 17 = 0 THEN ' acq-' || CAST(c.c_custkey AS VARCHAR)
         ELSE 'ACQ-' || CAST(c.c_custkey AS VARCHAR) END AS acquirer_id,
    ' ' || c.c_name AS acquirer_name,
    CASE c.c_custkey % 4 WHEN 0 THEN 'strategic' WHEN 1 THEN ' Financial Sponsor'
                         WHEN 2 THEN 'STRATEGIC' ELSE c.c_mktsegment END AS acquirer_type,
    c.c_mktsegment AS primary_sector_focus,
    n.n_name AS headquarters,
    CASE WHEN c.c_custkey % 4 = 1 THEN 'Private' ELSE 'NYSE: ' || c.c_mktsegment END AS ticker_or_status,
    CASE WHEN c.c_custkey % 53 = 0 THEN 'n/a' ELSE CAST(c.c_custkey % 5000 AS VARCHAR) END AS employee_count,
    CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS annual_revenue_mm,
    CAST(1950 + c.c_custkey % 60 AS VARCHAR) || '/01/01' AS founded_date,
    CASE WHEN c.c_custkey % 3 = 0 THEN 'National' ELSE 'Multi-Regional' END AS geographic_reach
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)""",
    "raw_targets": """
raw_targets AS (
  SELECT
    'tgt-' || CAST(p_partkey AS VARCHAR) AS target_id,
    p_name AS target_name,
    ' ' || p_brand AS sector,
    p_type AS sub_sector,
    'US' AS geography,
    CASE WHEN p_partkey % 2 = 0 THEN 'Private' ELSE 'PE-Backed' END AS ownership_type,
    CAST(1980 + p_partkey % 40 AS VARCHAR) || '-6-1' AS founded_date,
    CAST(p_size AS VARCHAR) AS employee_count,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS ltm_revenue_mm,
    CAST(p_size - 10 AS VARCHAR) AS ebitda_margin_pct,
    CASE WHEN p_partkey % 31 = 0 THEN 'NULL' ELSE CAST(p_size - 20 AS VARCHAR) END AS revenue_growth_pct
  FROM part
)""",
    "raw_acquirer_financials": """
raw_acquirer_financials AS (
  SELECT
    'ACQ-' || CAST(o_custkey AS VARCHAR) AS acquirer_id,
    CAST(fy AS VARCHAR) AS fiscal_year,
    CAST(rev AS VARCHAR) AS revenue_mm,
    CAST(CAST(rev * 0.2 AS DECIMAL(18,1)) AS VARCHAR) AS ebitda_mm,
    '20.0' AS ebitda_margin_pct,
    CAST(lo - 5000 AS VARCHAR) AS net_debt_mm,
    CAST(lo AS VARCHAR) AS cash_on_hand_mm,
    CAST(hi AS VARCHAR) AS total_assets_mm,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(hi AS VARCHAR) END AS market_cap_mm,
    CAST(n AS VARCHAR) AS employee_count
  FROM (
    SELECT o_custkey, year(o_orderdate) AS fy,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rev,
           min(CAST(o_totalprice AS DECIMAL(18,2))) AS lo,
           max(CAST(o_totalprice AS DECIMAL(18,2))) AS hi,
           count(*) AS n
    FROM orders GROUP BY o_custkey, year(o_orderdate)
  ) g
)""",
    "raw_sector_multiples": """
raw_sector_multiples AS (
  SELECT
    ' ' || p_brand AS sector,
    CAST(fy AS VARCHAR) AS fiscal_year,
    'Q' || CAST(fq AS VARCHAR) AS fiscal_quarter,
    CAST(CAST(quantile_cont(v / 200, 0.5) AS DECIMAL(18,2)) AS VARCHAR) AS median_ev_ebitda,
    CAST(CAST(quantile_cont(v / 200, 0.25) AS DECIMAL(18,2)) AS VARCHAR) AS p25_ev_ebitda,
    CAST(CAST(quantile_cont(v / 200, 0.75) AS DECIMAL(18,2)) AS VARCHAR) AS p75_ev_ebitda,
    CAST(CAST(quantile_cont(v / 800, 0.5) AS DECIMAL(18,2)) AS VARCHAR) AS median_ev_revenue,
    CAST(CAST(quantile_cont(v / 800, 0.25) AS DECIMAL(18,2)) AS VARCHAR) AS p25_ev_revenue,
    CAST(CAST(quantile_cont(v / 800, 0.75) AS DECIMAL(18,2)) AS VARCHAR) AS p75_ev_revenue,
    CAST(count(*) AS VARCHAR) AS deal_count
  FROM (
    SELECT p.p_brand, l.l_extendedprice / l.l_quantity AS v,
           year(l.l_shipdate) AS fy, quarter(l.l_shipdate) AS fq
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  ) x
  GROUP BY p_brand, fy, fq
)""",
}

# Column rules per staged entity: name and kind. The kinds are in RULES.
ENTITIES: dict[str, list[tuple[str, str]]] = {
    "acquirers": [
        ("acquirer_id", "key"), ("acquirer_name", "text"), ("acquirer_type", "buyer"), ("primary_sector_focus", "text"),
        ("headquarters", "text"), ("ticker_or_status", "text"), ("employee_count", "int"),
        ("annual_revenue_mm", "double"), ("founded_date", "date"), ("geographic_reach", "text")],
    "targets": [
        ("target_id", "key"), ("target_name", "text"), ("sector", "text"), ("sub_sector", "text"), ("geography", "text"),
        ("ownership_type", "text"), ("founded_date", "date"), ("employee_count", "int"), ("ltm_revenue_mm", "double"),
        ("ebitda_margin_pct", "double"), ("revenue_growth_pct", "double")],
    "transactions": [
        ("transaction_id", "key"), ("target_id", "id"), ("acquirer_id", "id"), ("announce_date", "date"),
        ("close_date", "date"), ("deal_year", "int"), ("deal_quarter", "text"), ("deal_type", "text"),
        ("financing_type", "text"), ("deal_size_mm", "double"), ("ev_ebitda_multiple", "double"),
        ("ev_revenue_multiple", "double"), ("synergy_pct_of_deal", "double"), ("outcome", "text"),
        ("strategic_rationale_tags", "text"), ("num_bidders", "int"), ("days_to_close", "int")],
    "acquirer_financials": [
        ("acquirer_id", "key"), ("fiscal_year", "int"), ("revenue_mm", "double"), ("ebitda_mm", "double"),
        ("ebitda_margin_pct", "double"), ("net_debt_mm", "double"), ("cash_on_hand_mm", "double"),
        ("total_assets_mm", "double"), ("market_cap_mm", "double"), ("employee_count", "int")],
    "sector_multiples": [
        ("sector", "text"), ("fiscal_year", "int"), ("fiscal_quarter", "text"), ("median_ev_ebitda", "double"),
        ("p25_ev_ebitda", "double"), ("p75_ev_ebitda", "double"), ("median_ev_revenue", "double"),
        ("p25_ev_revenue", "double"), ("p75_ev_revenue", "double"), ("deal_count", "int")],
}
HASHED = ("acquirers", "targets")
RULES = {
    "key": "upper(trim({c}))", "id": "upper(trim({c}))", "text": "trim({c})",
    "buyer": "coalesce(MAP {{'strategic': 'Strategic', 'financial sponsor': 'Financial Sponsor'}}[lower(trim({c}))], trim({c}))",
    "int": "TRY_CAST({c} AS INTEGER)", "double": "TRY_CAST({c} AS DOUBLE)",
    "date": "TRY_CAST(replace(trim({c}), '/', '-') AS DATE)",
}


def _hash_sql(columns: list[tuple[str, str]]) -> str:
    """md5 over all but the key, in order: doubles as six-digit decimals, NULL as empty text."""
    shown = [f"TRY_CAST({c} AS DECIMAL(38,6))" if kind == "double" else c for c, kind in columns if kind != "key"]
    return "md5(concat_ws('||', " + ", ".join(f"coalesce(CAST({x} AS VARCHAR), '')" for x in shown) + "))"


def stage_sql(entity: str, source: str | None = None, name: str | None = None) -> str:
    """CTE of a staged entity: rules per column, rows without a key left out, then its hash."""
    columns = ENTITIES[entity]
    typed = ", ".join(f"{RULES[kind].format(c='r.' + c)} AS {c}" for c, kind in columns)
    kept = [f"nullif({RULES['key'].format(c='r.' + c)}, '') IS NOT NULL" for c, kind in columns if kind == "key"]
    if entity == "transactions":  # quarantined
        kept.append("(TRY_CAST(r.deal_size_mm AS DOUBLE) < 0) IS NOT TRUE")
    rows = f"SELECT {typed} FROM {source or 'raw_' + entity} r" + (" WHERE " + " AND ".join(kept) if kept else "")
    if entity in HASHED:
        rows = f"SELECT *, {_hash_sql(columns)} AS row_content_hash FROM ({rows}) typed"
    return f"\n{name or 'stg_' + entity} AS ({rows})"


STG = {f"stg_{e}": (f"raw_{e}", stage_sql(e)) for e in ENTITIES}
DIM = {f"dim_{one}": (f"stg_{one}s", f"\ndim_{one} AS (SELECT *, {DATA_DATE_SQL} AS data_date FROM stg_{one}s)")
       for one in ("acquirer", "target")}


def _deps(name: str) -> list[str]:
    if name in RAW:
        return [name]
    if name in STG:
        return _deps(STG[name][0]) + [name]
    if name in DIM:
        return _deps(DIM[name][0]) + [name]
    raise KeyError(name)


def with_ctes(needed: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs for ``needed`` and their inputs, once each."""
    order: list[str] = []
    for n in needed:
        for d in _deps(n):
            if d not in order:
                order.append(d)
    parts = [RAW.get(n) or (STG.get(n) or DIM.get(n))[1] for n in order]
    return "WITH " + ",".join(parts) + "\n" + body


def _select_all(cte: str) -> str:
    return with_ctes([cte], f"SELECT * FROM {cte}")


# What each side adds to a deal: its column there, and the name in the fact.
SIDES = {
    "target": {"target_name": "target_name", "sector": "target_sector", "sub_sector": "target_sub_sector",
               "geography": "target_geography", "ownership_type": "target_ownership_type",
               "ltm_revenue_mm": "target_ltm_revenue_mm", "ebitda_margin_pct": "target_ebitda_margin_pct"},
    "acquirer": {"acquirer_name": "acquirer_name", "acquirer_type": "acquirer_type",
                 "primary_sector_focus": "acquirer_sector_focus", "geographic_reach": "acquirer_geographic_reach"},
    "benchmark": {"median_ev_ebitda": "sector_median_ev_ebitda", "median_ev_revenue": "sector_median_ev_revenue"},
    "year": {"revenue_mm": "acquirer_fiscal_revenue_mm", "ebitda_mm": "acquirer_fiscal_ebitda_mm",
             "net_debt_mm": "acquirer_net_debt_mm", "cash_on_hand_mm": "acquirer_cash_mm",
             "total_assets_mm": "acquirer_total_assets_mm"},
}
TIERS = ((100, "Small"), (500, "Mid-Market"), (2000, "Large"))


def _side(side: str, keys: dict[str, str], source: str) -> str:
    columns = {**keys, **SIDES[side]}
    return f"{side} AS (SELECT " + ", ".join(f"{c} AS {alias}" for c, alias in columns.items()) + f" FROM {source})"


def _gap(measure: str, benchmark: str) -> str:
    """Percent over the benchmark; nothing without both, or with a benchmark of about zero."""
    return f"CASE WHEN abs({benchmark}) > 1e-9 THEN ({measure} - {benchmark}) / {benchmark} * 100.0 END"


def fact_sql(deals: str = "stg_transactions", targets: str = "dim_target", date: str = DATA_DATE_SQL,
             extra: str = "") -> str:
    """The fact over ``deals``; ``extra`` are CTEs that the names given come from."""
    tier = " ".join(f"WHEN deal_size_mm < {bound} THEN '{label}'" for bound, label in TIERS)
    return with_ctes(
        ["stg_transactions", "dim_target", "dim_acquirer", "stg_sector_multiples", "stg_acquirer_financials"],
        ", " + extra + ",\n".join([
            f"deal AS (SELECT *, CAST(year(announce_date) AS INTEGER) AS filing_year FROM {deals})",
            _side("target", {"target_id": "target_id"}, targets),
            _side("acquirer", {"acquirer_id": "acquirer_id"}, "dim_acquirer"),
            _side("benchmark", {"sector": "target_sector", "fiscal_year": "deal_year", "fiscal_quarter": "deal_quarter"},
                  "stg_sector_multiples"),
            _side("year", {"acquirer_id": "acquirer_id", "fiscal_year": "filing_year"}, "stg_acquirer_financials"),
        ]) + f"""
SELECT * EXCLUDE (filing_year),
  {_gap('ev_ebitda_multiple', 'sector_median_ev_ebitda')} AS ev_ebitda_pct_vs_sector_median,
  {_gap('ev_revenue_multiple', 'sector_median_ev_revenue')} AS ev_revenue_pct_vs_sector_median,
  CASE WHEN deal_size_mm IS NOT NULL THEN CASE {tier} ELSE 'Mega' END END AS deal_size_tier,
  {date} AS data_date
FROM deal LEFT JOIN target USING (target_id)
  LEFT JOIN benchmark USING (target_sector, deal_year, deal_quarter)
  LEFT JOIN acquirer USING (acquirer_id)
  LEFT JOIN year USING (acquirer_id, filing_year)
""")


IN_DOMAIN = "WHERE deal_year BETWEEN 1990 AND 2035"
JOINED_SQL = fact_sql()
FACT_SQL = JOINED_SQL + IN_DOMAIN + "\n"


def _listed(field: str) -> str:
    """A field of an acquirer's deals in order, joined; NULL if no deal has it."""
    values = f"list_filter(list_transform(deals, lambda x: x.{field}), lambda v: v IS NOT NULL)"
    return f"CASE WHEN len({values}) > 0 THEN array_to_string({values}, ' | ') END"


def _total(field: str) -> str:
    return f"sum(CAST({field} AS DECIMAL(38,6)))"


_DEAL_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in ["announce_date", "transaction_id", "deal_type", "label"])
_SIGNED = ["deal_count", "volume", "ebitda_total", "ebitda_deals", "revenue_total", "revenue_deals",
           "distinct_target_sectors", "deal_types_observed", "sectors_touched", "first_transaction_date",
           "most_recent_transaction_date", "active_years"]

ACTIVITY_SQL = with_ctes(["stg_transactions", "dim_target", "dim_acquirer"], f"""
, labelled AS (
  SELECT d.*, t.sector, coalesce(t.sector, 'Unknown') AS label
  FROM stg_transactions d LEFT JOIN dim_target t USING (target_id)
), book AS (
  SELECT acquirer_id, list({{'kind': deal_type, 'label': label}} ORDER BY {_DEAL_ORDER}) AS deals,
    {_total('deal_size_mm')} AS volume, {_total('ev_ebitda_multiple')} AS ebitda_total,
    {_total('ev_revenue_multiple')} AS revenue_total, count(ev_ebitda_multiple) AS ebitda_deals,
    count(ev_revenue_multiple) AS revenue_deals, count(DISTINCT sector) AS distinct_target_sectors,
    min(announce_date) AS first_transaction_date, max(announce_date) AS most_recent_transaction_date,
    1 + max(deal_year) - min(deal_year) AS years
  FROM labelled GROUP BY ALL
), measured AS (
  SELECT *, len(deals) AS deal_count, {_listed('kind')} AS deal_types_observed, {_listed('label')} AS sectors_touched,
    CASE WHEN acquirer_id IS NOT NULL THEN years END AS active_years
  FROM book
)
SELECT m.acquirer_id, a.acquirer_name, a.acquirer_type, deal_count, distinct_target_sectors, deal_types_observed,
  sectors_touched, first_transaction_date, most_recent_transaction_date,
  CAST(volume AS DOUBLE) AS total_deal_volume_mm,
  CAST(ebitda_total AS DOUBLE) / nullif(ebitda_deals, 0) AS avg_ev_ebitda_multiple,
  CAST(revenue_total AS DOUBLE) / nullif(revenue_deals, 0) AS avg_ev_revenue_multiple,
  CAST(deal_count AS DOUBLE) / nullif(active_years, 0) AS avg_deals_per_active_year,
  md5(concat_ws('||', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _SIGNED)})) AS row_content_hash,
  {DATA_DATE_SQL} AS data_date
FROM measured m LEFT JOIN dim_acquirer a USING (acquirer_id)
""")

REPORT_SQL = with_ctes(["stg_transactions", "dim_target"], f"""
, placed AS (
  SELECT sector, deal_year, lower(outcome) AS state, deal_size_mm AS size, ev_ebitda_multiple AS e, ev_revenue_multiple AS r
  FROM dim_target SEMI JOIN (SELECT target_id FROM stg_transactions) USING (target_id)
  JOIN (SELECT * FROM stg_transactions) USING (target_id)
), cell AS (
  SELECT sector, deal_year, count(*) AS transaction_count, {_total('size')} AS size_total,
    {_total('e')} AS e_total, count(e) AS e_deals, {_total('r')} AS r_total, count(r) AS r_deals,
    count(*) FILTER (starts_with(state, 'closed')) AS closed_deal_count,
    count(*) FILTER (starts_with(state, 'pending')) AS pending_deal_count
  FROM placed GROUP BY ALL
)
SELECT sector, deal_year, transaction_count, closed_deal_count, pending_deal_count,
  CAST(size_total AS DOUBLE) AS total_deal_size_mm,
  CAST(e_total AS DOUBLE) / nullif(e_deals, 0) AS avg_ev_ebitda_multiple,
  CAST(r_total AS DOUBLE) / nullif(r_deals, 0) AS avg_ev_revenue_multiple,
  {DATA_DATE_SQL} AS data_date
FROM cell ORDER BY sector, deal_year
""")

_SEQ_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in [
    "announce_date", "transaction_id", "acquirer_id", "close_date", "outcome", "deal_size_mm",
    "ev_ebitda_multiple", "ev_revenue_multiple", "deal_year", "deal_quarter", "deal_type",
    "financing_type", "num_bidders", "days_to_close"])
_CARRIED = ["transaction_id", "announce_date", "close_date", "outcome", "deal_size_mm", "ev_ebitda_multiple", "acquirer_id"]

SEQUENCE_SQL = with_ctes(["stg_transactions", "dim_target"], f"""
, line AS (
  SELECT * EXCLUDE (synergy_pct_of_deal, strategic_rationale_tags),
    row_number() OVER (PARTITION BY target_id ORDER BY {_SEQ_ORDER}) AS deal_sequence_number
  FROM stg_transactions WHERE target_id IS NOT NULL
), earlier AS (
  SELECT target_id, deal_sequence_number + 1 AS deal_sequence_number, {', '.join(f'{c} AS prior_{c}' for c in _CARRIED)}
  FROM line
)
SELECT line.*, t.target_name, t.sector AS target_sector, {', '.join(f'prior_{c}' for c in _CARRIED)},
  date_diff('day', prior_announce_date, announce_date) AS days_since_prior_announce,
  deal_size_mm - prior_deal_size_mm AS deal_size_mm_delta_vs_prior,
  ev_ebitda_multiple - prior_ev_ebitda_multiple AS ev_ebitda_multiple_delta_vs_prior,
  CASE WHEN prior_acquirer_id IS NULL THEN false ELSE prior_acquirer_id = acquirer_id END AS same_acquirer_as_prior,
  {DATA_DATE_SQL} AS data_date
FROM line LEFT JOIN earlier USING (target_id, deal_sequence_number) LEFT JOIN dim_target t USING (target_id)
""")

QUARANTINE_SQL = with_ctes(["raw_transactions"], """
SELECT r.*,
  CASE WHEN trim(coalesce(transaction_id, '')) = '' THEN 'missing_transaction_id'
       WHEN TRY_CAST(deal_size_mm AS DOUBLE) < 0 THEN 'negative_deal_size' END AS quarantine_reason
FROM raw_transactions r
WHERE trim(coalesce(transaction_id, '')) = '' OR coalesce(TRY_CAST(deal_size_mm AS DOUBLE) < 0, false)
""")

ORACLE: dict[str, str] = {
    **{k: _select_all(k) for k in RAW},
    **{k: _select_all(k) for k in STG},
    **{k: _select_all(k) for k in DIM},
    "transactions_quarantine": QUARANTINE_SQL,
    "fct_transactions": JOINED_SQL,
    "dim_acquirer_activity": ACTIVITY_SQL,
    "rpt_sector_trend_summary": REPORT_SQL,
    "fct_target_deal_sequence": SEQUENCE_SQL,
}


# --- checks -----------------------------------------------------------------

def _verdict_sql(name: str, table: str, source: str, severity: str = "ERROR") -> str:
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{severity}' AS severity, "
            f"CAST(count(*) AS BIGINT) AS violations, count(*) = 0 AS passed FROM {source}")


def _dupes(table: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1) d"


_BUSINESS_DAYS = """(
  SELECT *, CASE WHEN n >= 0 THEN (n // 7) * 5
      + greatest(0, least(f + (n - (n // 7) * 7), 5) - greatest(f, 0))
      + greatest(0, least(f + (n - (n // 7) * 7), 12) - greatest(f, 7)) END AS bd
  FROM (SELECT *, date_diff('day', announce_date, close_date) AS n,
               isodow(announce_date + 1) - 1 AS f FROM stg_transactions) x
) b WHERE announce_date IS NOT NULL AND close_date IS NOT NULL AND days_to_close IS NOT NULL
      AND bd IS NOT NULL AND abs(days_to_close - bd) > 1"""

CHECK_SQL: dict[str, tuple[list[str], str]] = {
    "chk_transactions_unique": (["stg_transactions"], _verdict_sql(
        "chk_transactions_unique", "transactions", _dupes("stg_transactions", "transaction_id"))),
    "chk_transactions_fk_acquirer": (["stg_transactions", "stg_acquirers"], _verdict_sql(
        "chk_transactions_fk_acquirer", "transactions",
        "stg_transactions t WHERE NOT EXISTS (SELECT 1 FROM stg_acquirers a WHERE a.acquirer_id = t.acquirer_id)")),
    "chk_transactions_fk_target": (["stg_transactions", "stg_targets"], _verdict_sql(
        "chk_transactions_fk_target", "transactions",
        "stg_transactions t WHERE NOT EXISTS (SELECT 1 FROM stg_targets x WHERE x.target_id = t.target_id)")),
    "chk_date_order": (["stg_transactions"], _verdict_sql(
        "chk_date_order", "transactions",
        "stg_transactions WHERE announce_date IS NOT NULL AND close_date IS NOT NULL "
        "AND close_date < announce_date")),
    "chk_closed_requires_close_date": (["stg_transactions"], _verdict_sql(
        "chk_closed_requires_close_date", "transactions",
        "stg_transactions WHERE lower(trim(coalesce(outcome, ''))) = 'closed' AND close_date IS NULL")),
    "chk_dates_require_days_to_close": (["stg_transactions"], _verdict_sql(
        "chk_dates_require_days_to_close", "transactions",
        "stg_transactions WHERE announce_date IS NOT NULL AND close_date IS NOT NULL AND days_to_close IS NULL")),
    "chk_targets_unique": (["stg_targets"], _verdict_sql(
        "chk_targets_unique", "targets", _dupes("stg_targets", "target_id"))),
    "chk_acquirers_unique": (["stg_acquirers"], _verdict_sql(
        "chk_acquirers_unique", "acquirers", _dupes("stg_acquirers", "acquirer_id"))),
    "chk_nonneg_acquirers": (["stg_acquirers"], _verdict_sql(
        "chk_nonneg_acquirers", "acquirers",
        "stg_acquirers WHERE employee_count < 0 OR annual_revenue_mm < 0")),
    "chk_nonneg_targets": (["stg_targets"], _verdict_sql(
        "chk_nonneg_targets", "targets", "stg_targets WHERE employee_count < 0 OR ltm_revenue_mm < 0")),
    "chk_nonneg_transactions": (["stg_transactions"], _verdict_sql(
        "chk_nonneg_transactions", "transactions",
        "stg_transactions WHERE deal_size_mm < 0 OR ev_ebitda_multiple < 0 OR ev_revenue_multiple < 0 "
        "OR synergy_pct_of_deal < 0 OR num_bidders < 0 OR days_to_close < 0")),
    "chk_nonneg_financials": (["stg_acquirer_financials"], _verdict_sql(
        "chk_nonneg_financials", "acquirer_financials",
        "stg_acquirer_financials WHERE employee_count < 0 OR revenue_mm < 0 OR ebitda_mm < 0 "
        "OR cash_on_hand_mm < 0 OR total_assets_mm < 0 OR market_cap_mm < 0")),
    "chk_nonneg_sector_multiples": (["stg_sector_multiples"], _verdict_sql(
        "chk_nonneg_sector_multiples", "sector_multiples",
        "stg_sector_multiples WHERE median_ev_ebitda < 0 OR p25_ev_ebitda < 0 OR p75_ev_ebitda < 0 "
        "OR median_ev_revenue < 0 OR p25_ev_revenue < 0 OR p75_ev_revenue < 0 OR deal_count < 0")),
    "chk_year_matches_announce": (["stg_transactions"], _verdict_sql(
        "chk_year_matches_announce", "transactions",
        "stg_transactions WHERE deal_year <> year(announce_date)")),
    "chk_quarter_matches_announce": (["stg_transactions"], _verdict_sql(
        "chk_quarter_matches_announce", "transactions",
        "stg_transactions WHERE deal_quarter <> 'Q' || CAST(quarter(announce_date) AS VARCHAR)")),
    "chk_percentile_order": (["stg_sector_multiples"], _verdict_sql(
        "chk_percentile_order", "sector_multiples",
        "stg_sector_multiples WHERE coalesce(p25_ev_ebitda > median_ev_ebitda OR median_ev_ebitda > p75_ev_ebitda, false) "
        "OR coalesce(p25_ev_revenue > median_ev_revenue OR median_ev_revenue > p75_ev_revenue, false)")),
    "chk_unique_fiscal_grain": (["stg_acquirer_financials"], _verdict_sql(
        "chk_unique_fiscal_grain", "acquirer_financials",
        _dupes("stg_acquirer_financials", "acquirer_id, fiscal_year"))),
    "chk_unique_benchmark_grain": (["stg_sector_multiples"], _verdict_sql(
        "chk_unique_benchmark_grain", "sector_multiples",
        _dupes("stg_sector_multiples", "sector, fiscal_year, fiscal_quarter"))),
    "chk_financing_by_deal_type": (["stg_transactions"], _verdict_sql(
        "chk_financing_by_deal_type", "transactions",
        "stg_transactions WHERE (deal_type = '1-URGENT' AND financing_type NOT IN ('A', 'N')) "
        "OR (deal_type = '5-LOW' AND financing_type NOT IN ('N', 'R')) "
        "OR (deal_type IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED') AND financing_type NOT IN ('A', 'N', 'R')) "
        "OR (deal_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') AND financing_type IS NOT NULL)",
        "WARN")),
    "chk_sub_sector_of_sector": (["stg_targets"], _verdict_sql(
        "chk_sub_sector_of_sector", "targets",
        "stg_targets t WHERE sector IS NOT NULL AND sub_sector IS NOT NULL AND (sector, sub_sector) NOT IN "
        "(SELECT (trim(p_brand), trim(p_type)) FROM part WHERE p_size <= 45)", "WARN")),
    "chk_multiple_by_deal_type": (["stg_transactions"], _verdict_sql(
        "chk_multiple_by_deal_type", "transactions",
        "stg_transactions WHERE (deal_type = '1-URGENT' AND ev_ebitda_multiple NOT BETWEEN 0 AND 7) "
        "OR (deal_type = '2-HIGH' AND ev_ebitda_multiple NOT BETWEEN 0 AND 7.5) "
        "OR (deal_type = '5-LOW' AND ev_ebitda_multiple NOT BETWEEN 4 AND 100)", "WARN")),
    "chk_id_format": (["stg_transactions"], _verdict_sql(
        "chk_id_format", "transactions",
        "stg_transactions WHERE NOT regexp_matches(transaction_id, '^TXN-[0-9]+$') "
        "OR NOT regexp_matches(target_id, '^TGT-[0-9]+$') OR NOT regexp_matches(acquirer_id, '^ACQ-[0-9]+$')")),
    "chk_id_format_acquirers": (["stg_acquirers"], _verdict_sql(
        "chk_id_format_acquirers", "acquirers", "stg_acquirers WHERE NOT regexp_matches(acquirer_id, '^ACQ-[0-9]+$')")),
    "chk_id_format_targets": (["stg_targets"], _verdict_sql(
        "chk_id_format_targets", "targets", "stg_targets WHERE NOT regexp_matches(target_id, '^TGT-[0-9]+$')")),
    "chk_sponsor_in_financials": (["stg_acquirers", "stg_acquirer_financials"], _verdict_sql(
        "chk_sponsor_in_financials", "acquirers",
        "stg_acquirers a WHERE a.acquirer_type = 'Financial Sponsor' AND EXISTS "
        "(SELECT 1 FROM stg_acquirer_financials f WHERE f.acquirer_id = a.acquirer_id)")),
    "chk_business_days": (["stg_transactions"], _verdict_sql(
        "chk_business_days", "transactions", _BUSINESS_DAYS, "WARN")),
    "chk_fiscal_year_range": (["stg_acquirer_financials"], _verdict_sql(
        "chk_fiscal_year_range", "acquirer_financials",
        "stg_acquirer_financials WHERE NOT (fiscal_year BETWEEN 1990 AND 2035)")),
    "chk_synergy_cap": (["stg_transactions"], _verdict_sql(
        "chk_synergy_cap", "transactions", "stg_transactions WHERE synergy_pct_of_deal > 100")),
    "chk_value_range": (["stg_transactions"], _verdict_sql(
        "chk_value_range", "transactions",
        "stg_transactions WHERE NOT (ev_ebitda_multiple BETWEEN 0 AND 100)", "WARN")),
    "chk_allowed_matrix": (["stg_acquirers"], _verdict_sql(
        "chk_allowed_matrix", "acquirers",
        "stg_acquirers a WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_name = a.headquarters)", "WARN")),
    "chk_private_has_no_market_cap": (["stg_acquirers", "stg_acquirer_financials"], _verdict_sql(
        "chk_private_has_no_market_cap", "acquirer_financials",
        "stg_acquirer_financials f WHERE f.market_cap_mm IS NOT NULL AND EXISTS "
        "(SELECT 1 FROM stg_acquirers a WHERE a.acquirer_id = f.acquirer_id AND a.ticker_or_status = 'Private')")),
    "chk_size_vs_headcount": (["stg_targets"], _verdict_sql(
        "chk_size_vs_headcount", "targets",
        "stg_targets WHERE employee_count > 0 AND ltm_revenue_mm IS NOT NULL "
        "AND NOT (ltm_revenue_mm / employee_count BETWEEN 0.001 AND 5.0)", "WARN")),
}

_RAW_COLUMNS = {
    "raw_acquirers": ["acquirer_id", "acquirer_name", "acquirer_type", "primary_sector_focus", "headquarters",
                      "ticker_or_status", "employee_count", "annual_revenue_mm", "founded_date",
                      "geographic_reach"],
    "raw_targets": ["target_id", "target_name", "sector", "sub_sector", "geography", "ownership_type",
                    "founded_date", "employee_count", "ltm_revenue_mm", "ebitda_margin_pct",
                    "revenue_growth_pct"],
    "raw_transactions": ["transaction_id", "target_id", "acquirer_id", "announce_date", "close_date",
                         "deal_year", "deal_quarter", "deal_type", "financing_type", "deal_size_mm",
                         "ev_ebitda_multiple", "ev_revenue_multiple", "synergy_pct_of_deal", "outcome",
                         "strategic_rationale_tags", "num_bidders", "days_to_close"],
    "raw_acquirer_financials": ["acquirer_id", "fiscal_year", "revenue_mm", "ebitda_mm", "ebitda_margin_pct",
                                "net_debt_mm", "cash_on_hand_mm", "total_assets_mm", "market_cap_mm",
                                "employee_count"],
    "raw_sector_multiples": ["sector", "fiscal_year", "fiscal_quarter", "median_ev_ebitda", "p25_ev_ebitda",
                             "p75_ev_ebitda", "median_ev_revenue", "p25_ev_revenue", "p75_ev_revenue",
                             "deal_count"],
}


def _sentinel_sql(raw: str) -> str:
    cond = " OR ".join(f"upper(trim({c})) IN ('NULL', 'NAN', 'NONE', 'N/A')" for c in _RAW_COLUMNS[raw])
    return _verdict_sql("chk_null_sentinels", raw, f"{raw} WHERE {cond}")


for _name, (_needs, _body) in CHECK_SQL.items():
    ORACLE[_name] = with_ctes(_needs, _body)

ORACLE["run_checks"] = with_ctes(
    sorted({n for needs, _ in CHECK_SQL.values() for n in needs}),
    "\nUNION ALL\n".join(body for _, body in CHECK_SQL.values()),
)
ORACLE["chk_null_sentinels"] = with_ctes(
    list(_RAW_COLUMNS), "\nUNION ALL\n".join(_sentinel_sql(r) for r in _RAW_COLUMNS))


# --- table maintenance, pipeline, sources ----------------------------------------

def _merge_sql(key: str, cols: list[str], t: str, s: str) -> str:
    pick = (f"s.present IS NOT NULL AND (t.present IS NULL OR "
            f"t.row_content_hash IS DISTINCT FROM s.row_content_hash)")
    sel = ",\n  ".join(f"CASE WHEN {pick} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"SELECT\n  {sel}\nFROM {t} t FULL JOIN {s} s ON t.{key} IS NOT DISTINCT FROM s.{key}"


_ACQ_COLS = ["acquirer_id", "acquirer_name", "acquirer_type", "primary_sector_focus", "headquarters",
             "ticker_or_status", "employee_count", "annual_revenue_mm", "founded_date", "geographic_reach",
             "row_content_hash", "data_date"]
_TGT_COLS = ["target_id", "target_name", "sector", "sub_sector", "geography", "ownership_type",
             "founded_date", "employee_count", "ltm_revenue_mm", "ebitda_margin_pct", "revenue_growth_pct",
             "row_content_hash", "data_date"]
_KEYNUM = "TRY_CAST(regexp_extract(trim({c}), '([0-9]+)$', 1) AS BIGINT)"

ORACLE["scd1_merge"] = with_ctes(["stg_acquirers"], f"""
, raw_acquirers_day2 AS (
  SELECT * REPLACE (CASE WHEN {_KEYNUM.format(c='acquirer_id')} % 5 = 0
                         THEN acquirer_name || ' Holdings' ELSE acquirer_name END AS acquirer_name)
  FROM raw_acquirers
), {stage_sql('acquirers', 'raw_acquirers_day2', 'stg_acquirers_day2').strip()},
day1 AS (
  SELECT * EXCLUDE (data_date), DATE '2025-01-01' AS data_date, 1 AS present
  FROM (SELECT *, NULL AS data_date FROM stg_acquirers) x
  WHERE {_KEYNUM.format(c='acquirer_id')} % 11 <> 0
), day2 AS (
  SELECT * EXCLUDE (data_date), DATE '2025-01-02' AS data_date, 1 AS present
  FROM (SELECT *, NULL AS data_date FROM stg_acquirers_day2) x
  WHERE {_KEYNUM.format(c='acquirer_id')} % 7 <> 0
)
{_merge_sql('acquirer_id', _ACQ_COLS, 'day1', 'day2')}
""")

ORACLE["scd1_merge_buckets"] = ORACLE["scd1_merge"]

ORACLE["incremental_refresh"] = with_ctes(["stg_targets"], f"""
, raw_targets_day2 AS (
  SELECT * REPLACE (CASE WHEN {_KEYNUM.format(c='target_id')} % 5 = 0
                         THEN target_name || ' Holdings' ELSE target_name END AS target_name)
  FROM raw_targets
), {stage_sql('targets', 'raw_targets_day2', 'stg_targets_day2').strip()},
day1 AS (SELECT *, DATE '2025-01-01' AS data_date, 1 AS present FROM stg_targets),
day2 AS (SELECT *, DATE '2025-01-02' AS data_date, 1 AS present FROM stg_targets_day2)
{_merge_sql('target_id', _TGT_COLS, 'day1', 'day2')}
""")

ORACLE["backfill_partitions"] = FACT_SQL


def _n(column: str = "transaction_id") -> str:
    return _KEYNUM.format(c=column)


# Deals sent by stream change the table that they meet: tags with a line end, corrections, withdrawals.
_SENT = f"""sent AS (
  SELECT * REPLACE (
    CASE WHEN n % 499 <> 0 AND n % 15 = 0 THEN 'Scale' || chr(10) || '"Synergy"' ELSE strategic_rationale_tags END
      AS strategic_rationale_tags,
    CASE WHEN corrected AND n % 3 = 1 THEN 'Final' WHEN corrected THEN 'Corrected' ELSE outcome END AS outcome,
    CASE WHEN corrected AND n % 2 = 0 THEN 1994 ELSE deal_year END AS deal_year)
  FROM (SELECT *, n % 499 <> 0 AND n % 5 <> 0 AND n % 45 = 1 AS corrected FROM (SELECT *, {_n()} AS n FROM stg_transactions))
  WHERE NOT (n % 499 <> 0 AND n % 5 <> 0 AND n % 90 = 2)),
"""
ORACLE["stream_ingest"] = fact_sql("(SELECT * EXCLUDE (n, corrected) FROM sent)", extra=_SENT) + IN_DOMAIN


def _over_sent(sql: str) -> str:
    """A model's SQL over what batch and stream left, instead of all staged deals."""
    head, cut, body = sql.partition("dim_target AS (")
    sent = _SENT.replace("sent AS (", "").rstrip().rstrip(",").removesuffix(")")
    return (head + f"sent AS (SELECT * EXCLUDE (n, corrected) FROM ({sent})), " + cut
            + body.replace("FROM stg_transactions", "FROM sent"))


ORACLE["stream_activity"] = _over_sent(ACTIVITY_SQL)
ORACLE["stream_timeline"] = _over_sent(SEQUENCE_SQL)
ORACLE["stream_report"] = _over_sent(REPORT_SQL)
ORACLE["stream_rejected"] = with_ctes(["raw_transactions", "stg_transactions"], f"""
, feed AS (SELECT {_n()} AS n, * FROM raw_transactions WHERE {_n()} % 499 <> 0),
kind AS (SELECT CASE WHEN n % 3 = 0 THEN 'wrong_header' WHEN n % 7 IN (1, 2) THEN 'wrong_width' END AS reason FROM feed)
SELECT reason, count(*) AS row_count FROM kind WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'logged', count(*) FROM (SELECT {_n()} AS n FROM stg_transactions)
WHERE n % 499 <> 0 AND n % 3 <> 0 AND n % 7 NOT IN (1, 2)""")
_RENAMED = """renamed AS (SELECT * REPLACE (CASE WHEN target_id = (
    SELECT 'TGT-' || max(TRY_CAST(regexp_extract(target_id, '([0-9]+)$', 1) AS BIGINT)) FROM stg_transactions)
  THEN 'Renamed' ELSE target_name END AS target_name) FROM dim_target), """
_AFTER = f"SELECT *, coalesce(bool_or(target_name = 'Renamed') OVER (PARTITION BY deal_year), false) AS replaced FROM (" + \
    fact_sql(targets="renamed", extra=_RENAMED) + IN_DOMAIN + ")"
ORACLE["incremental_refresh_years"] = f"""
SELECT * REPLACE (CASE WHEN replaced THEN DATE '2025-01-02' ELSE DATE '2025-01-01' END AS data_date) FROM ({_AFTER})"""
_CHANGED_INPUTS = {
    "FROM dim_acquirer)": f"FROM (SELECT * REPLACE (CASE WHEN {_n('acquirer_id')} % 5 = 0 THEN acquirer_name || ' Holdings' "
                          "ELSE acquirer_name END AS acquirer_name) FROM dim_acquirer))",
    "FROM stg_sector_multiples)": "FROM stg_sector_multiples WHERE fiscal_year <> 1995)",
    "FROM stg_acquirer_financials)": "FROM (SELECT * REPLACE (CASE WHEN fiscal_year = 1997 THEN 1.5 ELSE revenue_mm END "
                                     "AS revenue_mm) FROM stg_acquirer_financials))"}


def _replaced_all(sql: str, changes: dict[str, str]) -> str:
    for old, new in changes.items():
        assert old in sql, old
        sql = sql.replace(old, new)
    return sql


ORACLE["incremental_refresh_inputs"] = _replaced_all(FACT_SQL, _CHANGED_INPUTS)
ORACLE["partition_replace"] = FACT_SQL + (
    "  AND (deal_year NOT IN (1996, 1997, 1999)\n"
    "   OR (deal_year IN (1996, 1999) AND outcome ILIKE 'Closed%'))\n")
# Deals of 1995 are gone; those whose key ends in 3 or 7 have left the domain or have no year.
ORACLE["incremental_refresh_fact"] = FACT_SQL + (
    f"  AND deal_year <> 1995 AND coalesce({_KEYNUM.format(c='transaction_id')} % 10, 0) NOT IN (3, 7)\n")


def _scanned(raw: str) -> str:
    key, text, *rest = _RAW_COLUMNS[raw]
    odd = f"CASE WHEN {_KEYNUM.format(c=key)} % 19 = 0 THEN 'say \"hi\",' || chr(10) || {text} ELSE {text} END"
    # An empty field and a missing one are the same in a file.
    fields = ", ".join(f"coalesce(nullif({c}, ''), '<null>')" for c in (key, odd, *rest))
    return (f"SELECT '{raw.removeprefix('raw_')}' AS source, {key} AS key, md5(concat_ws('|', {fields})) AS fields_md5 FROM {raw}")


ORACLE["scan_csv_strings"] = with_ctes(list(_RAW_COLUMNS), "\nUNION ALL\n".join(_scanned(r) for r in _RAW_COLUMNS))
ORACLE["changed_files"] = with_ctes(["raw_acquirers", "raw_targets"], """
SELECT 'targets' AS source, 'modified' AS status, count(*) AS row_count FROM raw_targets
UNION ALL SELECT 'acquirers_extra', 'new', count(*) FROM raw_acquirers
UNION ALL SELECT 'sector_multiples', 'removed', 0""")
ORACLE["ensure_column"] = with_ctes(["stg_targets"], """
SELECT target_id, target_name, sector, sub_sector, geography, ownership_type, founded_date,
       employee_count, ltm_revenue_mm, ebitda_margin_pct, revenue_growth_pct, row_content_hash,
       CAST(NULL AS DATE) AS data_date
FROM stg_targets
""")

_COUNTED = {
    "raw.acquirers": "raw_acquirers", "raw.targets": "raw_targets", "raw.transactions": "raw_transactions",
    "raw.acquirer_financials": "raw_acquirer_financials", "raw.sector_multiples": "raw_sector_multiples",
    "staging.acquirers": "stg_acquirers", "staging.targets": "stg_targets",
    "staging.transactions": "stg_transactions", "staging.acquirer_financials": "stg_acquirer_financials",
    "staging.sector_multiples": "stg_sector_multiples",
    "analytics.dim_acquirer": "dim_acquirer", "analytics.dim_target": "dim_target",
}


def _count_rows_sql() -> str:
    parts = [f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}" for name, cte in _COUNTED.items()]
    body = "\nUNION ALL\n".join(parts)
    derived = {
        "staging.transactions_quarantine": QUARANTINE_SQL,
        "analytics.fct_transactions": FACT_SQL,
        "analytics.dim_acquirer_activity": ACTIVITY_SQL,
        "analytics.rpt_sector_trend_summary": REPORT_SQL,
        "analytics.fct_target_deal_sequence": SEQUENCE_SQL,
    }
    for name, sql in derived.items():
        body += f"\nUNION ALL\nSELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql}) q"
    return with_ctes(list(_COUNTED.values()), body)


ORACLE["catalog_sql"] = f"""
WITH fact AS ({FACT_SQL}), line AS ({SEQUENCE_SQL}), buyer AS (SELECT DISTINCT acquirer_id FROM ({ACTIVITY_SQL}))
SELECT deal_year, count(*) AS deals,
  count(*) FILTER (deal_year IN (1997, 1998) AND target_name IS NOT NULL AND {_KEYNUM.format(c='target_id')} % 5 = 0) AS renamed_deals,
  count(*) FILTER (acquirer_id IN (SELECT acquirer_id FROM buyer WHERE acquirer_id IS NOT NULL)) AS known_buyers,
  max((SELECT max(deal_sequence_number) FROM line WHERE line.transaction_id = fact.transaction_id)) AS longest
FROM fact GROUP BY deal_year"""
ORACLE["row_count_metrics"] = _count_rows_sql()
ORACLE["reset_layers"] = f"""
SELECT split_part(table_name, '.', 1) AS layer, CAST(sum(row_count) AS BIGINT) AS rows_dropped, true AS dropped,
  0::INTEGER AS tables_left
FROM ({_count_rows_sql()}) counted WHERE table_name <> 'analytics.fct_transactions' GROUP BY layer"""
ORACLE["export_csv_with_manifest"] = (
    f"SELECT 'fct_transactions' AS table_name, count(*) AS row_count FROM ({JOINED_SQL}) a\n"
    f"UNION ALL SELECT 'dim_acquirer_activity', count(*) FROM ({ACTIVITY_SQL}) b\n"
    f"UNION ALL SELECT 'rpt_sector_trend_summary', count(*) FROM ({REPORT_SQL}) c\n")


# --- operator-level views ----------------------------------------------------------

def _project(sql: str, cols: str) -> str:
    return f"SELECT {cols} FROM (\n{sql}\n) q"


ORACLE.update({
    "join_left_single": _project(JOINED_SQL, "transaction_id, target_id, target_name, target_sector"),
    "join_left_composite": _project(JOINED_SQL, "transaction_id, target_sector, deal_year, deal_quarter, "
                                              "sector_median_ev_ebitda, sector_median_ev_revenue"),
    "join_left_expr_key": _project(JOINED_SQL, "transaction_id, acquirer_id, announce_date, "
                                             "acquirer_fiscal_revenue_mm, acquirer_net_debt_mm"),
    "join_inner": with_ctes(["stg_transactions", "dim_target"], """
SELECT t.transaction_id, t.target_id, tg.sector
FROM stg_transactions t JOIN dim_target tg ON tg.target_id = t.target_id"""),
    "anti_not_exists": with_ctes(["stg_transactions", "stg_acquirers"], """
SELECT t.transaction_id, t.acquirer_id FROM stg_transactions t
WHERE NOT EXISTS (SELECT 1 FROM stg_acquirers a WHERE a.acquirer_id = t.acquirer_id)"""),
    "agg_count_sum_avg_min_max": _project(ACTIVITY_SQL, "acquirer_id, deal_count, total_deal_volume_mm, "
                                          "avg_ev_ebitda_multiple, first_transaction_date, "
                                          "most_recent_transaction_date"),
    "agg_count_distinct": _project(ACTIVITY_SQL, "acquirer_id, distinct_target_sectors"),
    "agg_string_concat": _project(ACTIVITY_SQL, "acquirer_id, deal_types_observed, sectors_touched"),
    "agg_span_ratio": _project(ACTIVITY_SQL, "acquirer_id, deal_count, avg_deals_per_active_year"),
    "agg_conditional_sum": _project(REPORT_SQL, "sector, deal_year, closed_deal_count, pending_deal_count"),
    "agg_having_dupes": with_ctes(["stg_transactions"], """
SELECT transaction_id, count(*) AS occurrences FROM stg_transactions
GROUP BY transaction_id HAVING count(*) > 1"""),
    "win_row_number": _project(SEQUENCE_SQL, "target_id, transaction_id, acquirer_id, announce_date, "
                                             "deal_sequence_number"),
    "win_lag": _project(SEQUENCE_SQL, "target_id, deal_sequence_number, prior_transaction_id, "
                                      "prior_announce_date, prior_close_date, prior_outcome, "
                                      "prior_deal_size_mm, prior_ev_ebitda_multiple, prior_acquirer_id"),
    "win_deltas": _project(SEQUENCE_SQL, "target_id, deal_sequence_number, days_since_prior_announce, "
                                         "deal_size_mm_delta_vs_prior, ev_ebitda_multiple_delta_vs_prior, "
                                         "same_acquirer_as_prior"),
    "deal_size_tier": _project(JOINED_SQL, "transaction_id, deal_size_mm, deal_size_tier"),
    "pct_vs_benchmark": _project(JOINED_SQL, "transaction_id, ev_ebitda_pct_vs_sector_median, "
                                           "ev_revenue_pct_vs_sector_median"),
    "row_content_hash": with_ctes(["stg_acquirers", "stg_targets"], """
SELECT acquirer_id AS entity_id, row_content_hash FROM stg_acquirers
UNION ALL SELECT target_id, row_content_hash FROM stg_targets"""),
})

_Q_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in ["quarantine_reason"] + _RAW_COLUMNS["raw_transactions"])
ORACLE["quarantine_preview"] = f"SELECT * FROM (\n{QUARANTINE_SQL}\n) q ORDER BY {_Q_ORDER} LIMIT 20"


def _width_sql(raw: str) -> str:
    k = f"coalesce({_KEYNUM.format(c=_RAW_COLUMNS[raw][0])}, 1)"
    return _verdict_sql("chk_csv_width", raw, f"{raw} WHERE {k} % 23 = 0 OR {k} % 29 = 0")


ORACLE["chk_csv_width"] = with_ctes(list(_RAW_COLUMNS), "\nUNION ALL\n".join(_width_sql(r) for r in _RAW_COLUMNS))

# --- checks against what a sector or a country has ----------------------------

_RATIOS = ("r AS (SELECT sector, CASE WHEN employee_count > 0 THEN ltm_revenue_mm / employee_count END AS v "
           "FROM stg_targets)")
ORACLE["size_vs_headcount_by_sector"] = with_ctes(["stg_targets"], f"""
SELECT sector, count(v) AS rows_with_ratio,
       count(*) FILTER (v < q1 - (q3 - q1)) AS below, count(*) FILTER (v > q3 + (q3 - q1)) AS above
FROM (SELECT sector, v, quantile_cont(v, 0.25) OVER s AS q1, quantile_cont(v, 0.75) OVER s AS q3
      FROM (WITH {_RATIOS} SELECT * FROM r) WINDOW s AS (PARTITION BY sector))
GROUP BY sector""")
ORACLE["size_vs_headcount_sketch"] = with_ctes(["stg_targets"], f"""
SELECT sector, count(v) AS rows_with_ratio, true AS within_error
FROM (WITH {_RATIOS} SELECT * FROM r) WHERE v IS NOT NULL GROUP BY sector""")
ORACLE["geography_consistency"] = """
WITH h AS (SELECT r_name AS country, n_name AS sub, n_nationkey, n_regionkey
           FROM nation JOIN region ON r_regionkey = n_regionkey),
offices AS (
  SELECT CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN ' , ;'
              WHEN c_custkey % 19 = 0 THEN sub || ', Atlantis' WHEN c_custkey % 17 = 0 THEN 'Atlantis; ' || country
              WHEN c_custkey % 13 = 0 THEN sub || ', ' || o.r_name WHEN c_custkey % 11 = 0 THEN sub
              WHEN c_custkey % 7 = 0 THEN lower(country || ' / ' || sub) ELSE sub || ',' || country END AS hq
  FROM customer JOIN h ON n_nationkey = c_nationkey JOIN region o ON o.r_regionkey = (n_regionkey + 1) % 5),
named AS (
  SELECT DISTINCT hq, upper(trim(x)) AS part
  FROM (SELECT DISTINCT hq, unnest(regexp_split_to_array(hq, '[,/;]')) AS x FROM offices) WHERE trim(x) <> ''),
judged AS (
  SELECT hq, part, part IN (SELECT country FROM h) AS land, part IN (SELECT sub FROM h) AS region_name,
         EXISTS (SELECT 1 FROM h JOIN named b ON b.part = h.country WHERE b.hq = named.hq AND h.sub = named.part) AS fits
  FROM named),
verdicts AS (
  SELECT hq, CASE WHEN bool_or(land) AND bool_or(region_name AND NOT land AND NOT fits) THEN 'mismatch'
                  WHEN bool_or(NOT land AND NOT region_name) THEN 'unknown'
                  WHEN bool_or(land) AND bool_or(region_name AND NOT land) THEN 'consistent' ELSE 'partial' END AS verdict
  FROM judged GROUP BY hq)
SELECT coalesce(verdict, 'missing') AS verdict, count(DISTINCT coalesce(o.hq, '-')) AS addresses,
       count(*) AS acquirers
FROM offices o LEFT JOIN verdicts v ON v.hq = o.hq GROUP BY 1"""
