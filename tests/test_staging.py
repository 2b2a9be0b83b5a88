from dealhouse.operators import staging as stg

TX_SCHEMA = ", ".join(f"{c} string" for c in stg.TRANSACTION_COLUMNS)


def tx_rows(spark, rows):
    full = [tuple(r.get(c) for c in stg.TRANSACTION_COLUMNS) for r in rows]
    return spark.createDataFrame(full, TX_SCHEMA)


def test_quarantine_and_clean_are_complements(spark):
    raw = tx_rows(spark, [
        {"transaction_id": "  ", "deal_size_mm": "-1"},          # both rules: missing id wins
        {"transaction_id": None, "deal_size_mm": "5"},
        {"transaction_id": "t-1", "deal_size_mm": "-5.5"},
        {"transaction_id": "t-2", "deal_size_mm": "n/a"},        # non-numeric size passes, NULL size
        {"transaction_id": " t-3 ", "deal_size_mm": None, "close_date": "  ", "num_bidders": "3.7"},
        {"transaction_id": "t-4", "deal_size_mm": "NaN"},
    ])
    q = {r["transaction_id"]: r["quarantine_reason"] for r in stg.transactions_quarantine(raw).collect()}
    clean = {r["transaction_id"]: r for r in stg.stg_transactions(raw).collect()}
    assert q == {"  ": "missing_transaction_id", None: "missing_transaction_id", "t-1": "negative_deal_size"}
    assert set(clean) == {"T-2", "T-3", "T-4"}
    assert clean["T-2"]["deal_size_mm"] is None
    assert clean["T-3"]["close_date"] is None and clean["T-3"]["num_bidders"] == 4
    assert len(q) + len(clean) == raw.count()


def test_acquirer_type_canonical_labels(spark):
    cols = stg.ACQUIRER_COLUMNS
    rows = [("a1", "n", t) + (None,) * (len(cols) - 3) for t in
            ["strategic", " Financial Sponsor", "STRATEGIC", "Other ", None]]
    rows.append(("  ",) + (None,) * (len(cols) - 1))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = [r["acquirer_type"] for r in stg.stg_acquirers(raw).collect()]
    assert got == ["Strategic", "Financial Sponsor", "Strategic", "Other", None]


def test_sector_multiples_keep_every_row(spark):
    cols = stg.MULTIPLE_COLUMNS
    raw = spark.createDataFrame([(None,) * len(cols), (" S ",) + ("x",) * (len(cols) - 1)],
                                ", ".join(f"{c} string" for c in cols))
    out = stg.stg_sector_multiples(raw).collect()
    assert len(out) == 2 and out[1]["sector"] == "S" and out[1]["deal_count"] is None
