from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from stockflow.llm import cascade, packing, toxicity
from stockflow.llm.oracle import ORACLE
from stockflow.llm.queries import QUERIES

from . import brute


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    import __spark_entry__

    assert QUERIES.keys() | {"pipeline"} <= __spark_entry__.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        db.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    want = db.sql(f"select {', '.join(got.columns)} from ({ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_pipeline_stages(spark, sf_dir):
    """Each stage does to its own input what the plain version of its operator does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "quality", "near_dedup", "passage_dedup", "packing"]
    rows = {r.doc_id: r for r in docs.collect()}
    fit = corpus_pipeline.stored(steps["toxicity"](spark, docs, sf_dir), "t1")
    kept = {r.doc_id: r for r in fit.collect()}
    flagged = {r.doc_id for r in toxicity.toxic(docs, docs, labels).where("toxic").collect()}
    assert kept.keys() == rows.keys() - flagged and fit.columns == docs.columns and all(kept[i] == rows[i] for i in kept)

    good = corpus_pipeline.stored(steps["quality"](spark, fit, sf_dir), "t2")
    judge = cascade.Cascade()
    assert {r.doc_id for r in good.collect()} == {
        i for i, r in kept.items() if not brute.quality(r.text)[1] and not judge.rejects(cascade.Text(r.text))
    }
    left = [(r.doc_id, r.text) for r in good.collect()]

    unique = corpus_pipeline.stored(steps["near_dedup"](spark, good, sf_dir), "t3")
    assert {r.doc_id for r in unique.collect()} == {c for _, c in brute.near_duplicates(left, 5, 80).values()}

    clean = corpus_pipeline.stored(steps["passage_dedup"](spark, unique, sf_dir), "t4")
    want = brute.repeats([(r.doc_id, r.text) for r in unique.collect()], 100)
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts.keys() == want.keys() and clean.columns == docs.columns
    assert all(0 <= len(texts[i].encode()) - len(want[i][4]) < 4 * (want[i][2] + 1) for i in want)
    assert all(r.n_chars == len(r.text) for r in clean.collect())

    packed = steps["packing"](spark, clean, sf_dir).collect()
    encoder = packing.Encoder(corpus_pipeline.vocabulary("word_bpe_49k.json"))
    assert sum(r.length for r in packed) == sum(encoder.ids(t).size for t in texts.values())


def test_pipeline_decides_by_row(spark, sf_dir, odd):
    """Null and repeated ids: every row is judged by its own text and comes out once."""
    steps = dict(corpus_pipeline.STAGES)
    columns = corpus_pipeline.COLUMNS
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select(columns)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flags = {r.doc_id: r.toxic for r in toxicity.toxic(given, given, labels).collect()}
    bad, good = (next(i for i in sorted(flags) if flags[i] is v) for v in (True, False))
    text = {r.doc_id: r.text for r in given.collect()}
    # 9_000_001 has two versions, of which one is toxic; neither id is labelled.
    extra = [(None, text[bad]), (None, text[good]), (9_000_001, text[bad]), (9_000_001, text[good])]
    more = given.union(spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in extra], given.schema))
    left = [(r.doc_id, r.text) for r in steps["toxicity"](spark, more, sf_dir).collect() if r.doc_id in (None, 9_000_001)]
    assert sorted(left, key=str) == sorted([(None, text[good]), (9_000_001, text[good])], key=str)

    judge = cascade.Cascade()
    fit = [r for r in odd.select(columns).collect() if not brute.quality(r.text)[1] and not judge.rejects(cascade.Text(r.text))]
    assert sorted(map(str, steps["quality"](spark, odd, sf_dir).collect())) == sorted(map(str, fit))
    assert 0 < len(fit) < 17

    rows = odd.select(columns).collect()
    numbered = sorted((r.doc_id, r.text or "") for r in rows if r.doc_id is not None)
    near = brute.near_duplicates(list(enumerate(t for _, t in numbered)), 5, 80)
    want = [numbered[c] for c in {c for _, c in near.values()}]
    unique = corpus_pipeline.stored(steps["near_dedup"](spark, odd, sf_dir), "odd3").collect()
    assert sorted((r.doc_id, r.text or "") for r in unique if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in unique) == 3

    clean = steps["passage_dedup"](spark, odd, sf_dir).collect()
    assert sorted(map(str, (r.doc_id for r in clean))) == sorted(map(str, (r.doc_id for r in rows)))
    repeats = brute.repeats(list(enumerate(t for _, t in numbered)), 100)
    sizes = sorted((i, len(repeats[n][4])) for n, (i, _) in enumerate(numbered))
    got = sorted((r.doc_id, len(r.text.encode())) for r in clean if r.doc_id is not None)
    assert [i for i, _ in got] == [i for i, _ in sizes] and all(abs(a - b) < 20 for (_, a), (_, b) in zip(got, sizes, strict=True))
    assert {r.text for r in clean if r.doc_id is None} == {"", next(r.text for r in rows if r.doc_id is None and r.text)}
    assert all(r.n_chars == len(r.text) and (r.lang, r.source) == ("en", "s") for r in clean)
