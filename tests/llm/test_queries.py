"""The registered queries: against their SQL, and the pipeline against its stages done by hand."""

import os

import duckdb
import numpy as np
import pytest
from test_decontaminate import brute as contaminated
from test_lines import passages as without_lines
from test_minhash import classes_of, shingles, similarity

import corpus_pipeline
from siltstone.llm.bloom import build, holds
from siltstone.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@needs_data
@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in "documents embeddings benchmark labels conversations".split():
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got, want = QUERIES[name](spark, SF), duck.sql(ORACLE[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want.select(*columns).fetchall(), key=repr)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@needs_data
def test_pipeline(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "tokens":
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(docs)
    rows = [[(r.doc_id, r.text) for r in k.collect()] for k in kept[:4]]
    assert sorted(rows[1]) == sorted((d, t) for d, t, _, _ in without_lines(rows[0]))
    first = {}
    for d, t in rows[1]:
        first[t] = min(first.get(t, d), d)
    found = classes_of(rows[1], lambda a, b: similarity(a, b) >= 0.8)
    want = [(d, t) for (d, t), c in zip(rows[1], found, strict=True) if (d == c if shingles(t) else d == first[t])]
    assert sorted(rows[2]) == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in contaminated(rows[2], items) if not r[5]}
    assert sorted(rows[3]) == sorted(r for r in rows[2] if r[0] in clean)
    assert sorted(r.doc_id for r in kept[4].collect()) == sorted(clean)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = {d for d, _ in rows[0]}
    judged = [(labels[r.doc_id], r.doc_id in good) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.doc_id in labels]
    assert np.mean([q == g for q, g in judged]) > 0.95


def test_filter_never_denies(spark):
    values = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    bits = build(spark.createDataFrame([(int(v),) for v in values] + [(None,)], "h long"), "h")
    assert holds(bits, values.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 2**63 - 1, 20000).view(np.uint64)
    assert holds(bits, others).mean() < 0.02
    full = build(spark.createDataFrame([(int(v),) for v in values], "h long"), "h", most_bits=1 << 16)
    assert holds(full, values.view(np.uint64)).all() and full.nbytes <= 1 << 14
    assert not holds(build(spark.createDataFrame([], "h long"), "h"), others).any()


def test_pipeline_keeps_one_of_many_copies(spark, tmp_path):
    """A third of all rows is one text of several lines: one of them comes out, and none that was emptied."""
    from conftest import prose

    copied = "\n".join(f"line {i} of what is copied again and again, {prose(i, 8)}" for i in range(12))
    rows = [(i, prose(i, 80)) for i in range(400)] + [(1000 + i, copied) for i in range(200)] + [(2000, None), (2001, ""), (2002, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = [(i, 1) for i in range(0, 400, 2)] + [(5000 + i, 0) for i in range(100)]
    junk = spark.createDataFrame([(5000 + i, f"$$ {i} !! ##" * 5, "en", "s", 40) for i in range(100)], docs.schema)
    docs.union(junk).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "none of this is in any document at all, is it")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # the first of those that were emptied stands for all texts without words
    assert sorted(d for d in got if 1000 <= d < 3000) == [1000, 1001] and got[1000] > 100 and got[1001] == 0
    assert sum(d in got for d in range(400)) > 390 and not any(d >= 5000 for d in got)
    assert sum(n == 0 for n in got.values()) <= 1
