"""The corpus pipeline: every stage's decisions on planted rows, and the registered queries."""
from __future__ import annotations

import random

import corpus_pipeline as cp
from dealhouse.llm import pieces, pii, simhash, toxicity
from dealhouse.llm.common import materialize
from dealhouse.llm.queries import LLM_ORACLE, LLM_QUERIES


def plant(spark, path):
    rng = random.Random(31)
    words = {"en": "the of and river stone wall".split(), "de": "der die und fluss stein wand".split()}
    docs, labels = [], []
    for i in range(300):
        lang = "de" if i % 5 == 0 else "en"
        text = [rng.choice(words[lang]) + rng.choice(["", str(rng.randrange(400))]) for _ in range(rng.randrange(30, 90))]
        toxic = i % 6 == 1
        if toxic:
            for _ in range(4):
                text.insert(rng.randrange(len(text)), rng.choice(["scum", "idiot", "vermin"]))
        docs.append((i, " ".join(text), lang, f"src{i % 3}"))
        if i % 10 < 8:
            labels.append((i, 1, int(toxic)))
    docs += [(1000 + k, docs[2][1], "en", "src0") for k in range(5)]
    docs += [(2000, "of an own wall and the river write bob@example.com or +1 (202) 555-0143", "en", "src1"), (2001, None, None, None),
             (2002, "", "en", "src2"), (2003, None, "de", "src0")]
    full = [(*d, None if d[1] is None else len(d[1])) for d in docs]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    df.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet"), docs


def test_stages(spark, tmp_root):
    docs, planted = plant(spark, tmp_root)
    texts = {d[0]: d[1] for d in planted}
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_root}/labels.parquet"))
    stage = {}
    rows = docs
    for name, fn in cp.STAGES:
        out = materialize(fn(spark, rows, tmp_root), "test-stage")
        if name != "sentencepiece":
            assert out.schema == docs.schema
        stage[name] = out.collect()
        if name == "near_duplicates":  # one document of each group, as all pairs have it
            groups = simhash.near_duplicates(rows).collect()
            assert sorted(r["doc_id"] for r in stage[name]) == sorted({r["component_id"] for r in groups})
        if name == "personal_data":
            span_model = pii.fit(pii.find_candidates(rows))
            before = {r["doc_id"]: r["text"] for r in rows.collect()}
            for r in stage[name]:
                old = before[r["doc_id"]]
                want = None if old is None else pii.mask(old, pii.decide(pii.candidates(old), span_model))
                assert r["text"] == want and r["n_chars"] == (None if want is None else len(want))
        rows = out
    kept = {r["doc_id"] for r in stage["toxicity"]}
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, model).collect()}
    assert kept == {i for i, s in scores.items() if s < toxicity.THRESHOLD}
    toxic = {i for i in texts if i < 300 and i % 6 == 1}
    assert not toxic & kept and kept == set(texts) - toxic
    assert not any(r["doc_id"] >= 1000 and r["doc_id"] < 2000 for r in stage["near_duplicates"])
    masked = {r["doc_id"]: r["text"] for r in stage["personal_data"]}
    assert masked[2000].endswith(" write [EMAIL] or [PHONE]")
    assert {r["doc_id"] for r in stage["mixing"]} == set(masked)  # nothing is left out, some are repeated
    assert len(stage["mixing"]) > len(masked)
    encoder = pieces.Encoder(pieces.Vocabulary.load(pieces.default_model()))
    last = stage["sentencepiece"]
    assert len(last) == len(stage["mixing"])
    for r in last[:50]:
        assert encoder.decode(r["ids"]) == (masked[r["doc_id"]] or "") and r["round_trip"]


def test_empty_tables(spark, tmp_root):
    docs, _ = plant(spark, tmp_root)
    empty = docs.limit(0)
    for _, fn in cp.STAGES:
        assert fn(spark, empty, tmp_root).count() == 0


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(LLM_ORACLE) <= set(LLM_QUERIES)
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "personal_data", "mixing", "sentencepiece"]
