"""URL verdicts against a plain walk over rules and alias components, and DuckDB."""
from __future__ import annotations

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dealhouse.llm import url_filter as uf
from dealhouse.llm.components import connected_components
from dealhouse.llm.url_oracle import oracle_sql

SCHEMA = "page_id long, url string, html string"


def canonical(href):
    return f'<html><head><link rel="canonical" href="{href}"></head></html>'


def refresh(href):
    return f'<META HTTP-EQUIV="refresh" content="0; url={href}">'


ROWS = [
    (1, "http://a.example.org/es/x", ""), (2, "http://example.org/en/12?q=1#top", None),
    (3, "https://WWW.Example.ORG/en/2", ""), (4, "http://b.com/de/1", ""), (5, "http://b.com/fr/1", ""),
    (6, "http://free.net/a", canonical("http://b.com/de/1")),         # alias of a blocked address
    (7, "http://other.net/", refresh("http://free.net/a")),           # alias of that alias
    (8, "http://good.net/a", canonical("http://b.com/de/2")),         # blocked alias ...
    (9, "http://good.net/a/", canonical("http://b.com/fr/7")),        # ... but the component is allowed too
    (10, "http://lone.net/en", ""), (11, "http://lone.net/en/?utm_source=x&p=1&ref=y", ""),
    (12, None, None), (13, "no scheme", ""), (14, "http://", ""), (15, "http://host.org", ""),
    (16, "http://rel.com/x/y?z", canonical("../de/1")), (17, "http://rel.com/x", canonical("/de/9")),
    (18, "http://n.net/q", canonical("//b.com/de/3")), (19, "http://n.net/r", canonical("")),
    (20, "http://b.com:80/de/1", ""), (21, "http://xexample.org/es/", ""), (4, "http://b.com/de/1", ""),
    (None, "http://b.com/de/1", "")]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def test_verdicts(pages):
    clash = pages.withColumn("node", F.lit(1)).withColumn("rule", F.lit(1)).withColumn("host", F.lit("x"))
    got = {r["page_id"]: r for r in uf.judge_urls(clash).collect()}
    verdicts = {i: (r["rule"], r["verdict"]) for i, r in got.items()}
    assert verdicts[1] == ("example.org/es/", "block")
    assert verdicts[2] == ("example.org/en/1", "block")
    assert verdicts[3] == ("org/", "allow") and got[3]["host"] == "www.example.org"
    assert verdicts[4] == ("com/de/", "block") and verdicts[5] == ("com/fr/", "allow")
    assert verdicts[6] == verdicts[7] == (None, "block")
    assert verdicts[8] == verdicts[9] == (None, "allow")
    assert verdicts[10] == verdicts[11] == verdicts[12] == verdicts[13] == verdicts[14] == (None, "allow")
    assert (got[12]["host"], got[12]["path"], got[13]["host"], got[15]["path"]) == ("", "", "", "")
    assert verdicts[15] == (None, "allow")     # org/ wants a path
    assert verdicts[17] == (None, "block") and verdicts[18] == (None, "block") and verdicts[19] == (None, "allow")
    assert verdicts[20] == (None, "allow")     # a port is part of the host
    assert verdicts[21] == ("org/", "allow")   # no subdomain of example.org
    assert len(uf.judge_urls(pages).collect()) == len(ROWS)


def test_equals_sql(pages):
    frame = pd.DataFrame([tuple(r) for r in pages.collect()], columns=["page_id", "url", "html"])
    with duckdb.connect() as con:
        con.register("pages", frame.astype({"page_id": "Int64"}))
        want = con.execute(oracle_sql(uf.RULES)).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in uf.judge_urls(pages).collect())


def test_long_redirect_chain(spark):
    rows = [(i, f"http://hop{i}.net/a", refresh(f"http://hop{i + 1}.net/a")) for i in range(40)]
    rows.append((40, "http://hop40.net/a", canonical("http://z.com/de/")))
    got = uf.judge_urls(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["verdict"] for r in got} == {"block"}


def test_empty_table(spark):
    assert uf.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_hub_a_chain_and_loops(spark):
    links = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(60)} | {i: 100 for i in range(100, 141)} | {200: 200, 201: 200}
    assert got == want


def test_bare_canonical_and_quoted_refresh_are_links(spark):
    tags = ["<link rel=canonical href=http://b.com/x>", "<link href=http://b.com/x rel=canonical>",
            "<link rel='canonical' href='http://b.com/x'>",
            """<meta http-equiv="refresh" content="0; url='http://b.com/x'">""",
            """<meta http-equiv=refresh content='0;URL="http://b.com/x"'>""",
            """<meta http-equiv="refresh" content="0; url=http://b.com/x">"""]
    pages = spark.createDataFrame([(i, f"http://a{i}.net/p", f"<html>{t}</html>") for i, t in enumerate(tags)]
                                  + [(99, "http://a99.net/p", None)], "page_id long, url string, html string")
    rules = (uf.Rule("block", "b.com", "/x"),)
    got = {r["page_id"]: r["verdict"] for r in uf.judge_urls(pages, rules).collect()}
    assert got == {**{i: "block" for i in range(len(tags))}, 99: "allow"}


BASE = "http://a.net/x/y.html?k=1#f"
REFERENCES = [
    ("/login?next=http://www.example.org/es/x", "a.net/login?next=http://www.example.org/es/x"),
    ("z", "a.net/x/z"), ("./z", "a.net/x/z"), ("../z", "a.net/z"), ("../../../z", "a.net/z"), ("..", "a.net/"),
    (".", "a.net/x/"), ("b/../c/./d", "a.net/x/c/d"), ("b/..", "a.net/x/"), ("?q=2", "a.net/x/y.html?q=2"),
    ("#top", None), ("", None), ("  ", None), ("z#top", "a.net/x/z"), ("//B.com/q/../p", "b.com/p"),
    ("HTTPS://B.com", "b.com"), ("https://b.com/a/../b", "b.com/b"), ("http://b.com?x=../y", "b.com?x=../y"),
    ("mailto:me@b.com", None), ("javascript:alert('http://b.com')", None), ("http:odd", None), ("z?a=1&amp;b=2", "a.net/x/z?a=1&b=2"),
    (" z ", "a.net/x/z"), ("/", "a.net/"), ("/..", "a.net/"), ("a:b/c", None), ("./a:b", "a.net/x/a:b"), ("...", "a.net/x/...")]


def test_references_resolve_by_the_rules(spark):
    rows = spark.createDataFrame([(BASE, ref) for ref, _ in REFERENCES], "url string, ref string")
    got = rows.select("ref", uf.resolve(F.col("url"), F.col("ref")).alias("to")).collect()
    assert [tuple(r) for r in got] == REFERENCES
    lone = spark.createDataFrame([("http://h.net", "z"), ("http://h.net", "?q"), ("no scheme", "z"), (None, "z"), ("http://h.net", None)],
                                 "url string, ref string")
    assert [r[0] for r in lone.select(uf.resolve(F.col("url"), F.col("ref"))).collect()] == [
        "h.net/z", "h.net?q", None, None, None]


def test_a_query_that_holds_a_url_is_no_link_to_it(spark):
    pages = spark.createDataFrame([(1, "http://a.net/p.html", canonical("/login?next=http://www.example.org/es/x"))], SCHEMA)
    assert uf.judge_urls(pages).first()["verdict"] == "allow"


def test_every_link_form_equals_sql(spark):
    forms = [canonical, refresh, lambda r: f"<link href='{r}' rel=canonical>", lambda r: f"<LINK data-href=\"/no\" REL='canonical' HREF=\"{r}\">",
             lambda r: f"<link rel=canonical data-href={r}>", lambda r: f"<link rel=stylesheet href=/css><link\nrel = canonical href = {r}>",
             lambda r: f"<meta http-equiv=\"refresh\" content=\"0; URL='{r}'\">", lambda r: f"<meta data-http-equiv=refresh content='0;url={r}'>",
             lambda r: f"<link rel=\"canonical\" href=\"{r}\"/>{refresh('/other')}"]
    targets = [r for r, _ in REFERENCES if "'" not in r] + ["http://b.com/de/1", "//www.example.org/es/", "../../en/1"]
    rows = [(i * 100 + j, f"http://{h}/d/p{i}-{j}", form(r)) for i, form in enumerate(forms) for j, r in enumerate(targets)
            for h in (f"s{i}.net",)]
    rows += [(9000 + j, f"https://www.Example.edu/d/e{j}?utm_x=1&a=2&&ref=3", f"<link rel=canonical href='{r}'>") for j, r in enumerate(targets)]
    rows += [(9900, "http://b.com/x", "<link rel=canonical"), (9901, None, canonical("/x")), (9902, "http://q.net/x?", ""),
             (9903, "http://big.net/x", "<p>" * 200_000 + canonical("http://b.com/de/1"))]
    pages = spark.createDataFrame(rows, SCHEMA)
    with duckdb.connect() as con:
        con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
        want = sorted(map(str, con.execute(oracle_sql(uf.RULES)).fetchall()))
    got = sorted(str(tuple(r)) for r in uf.judge_urls(pages).collect())
    assert got == want and sum("'block'" in r for r in got) > 10
