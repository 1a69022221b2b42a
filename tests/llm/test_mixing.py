from collections import defaultdict

import pytest
from brute import as_dicts, mixed, rows
from pyspark.sql import functions as F

from tripmill.llm import mixing, queries


def keys(spark, docs):
    """Places in the queue, which the plain version takes as given."""
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    made = df.select("doc_id", "source", "text", mixing.queue_key().alias("k")).collect()
    return {(r.doc_id, r.source, r.text): r.k for r in made}


def found(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])
                   for r in as_dicts(df)), key=repr)


def close(got, want):
    want = sorted(want, key=repr)
    assert [(g[0], g[1], g[2], g[4]) for g in got] == [(w[0], w[1], w[2], w[4]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_every_document(spark, sf_dir):
    docs = [(d["doc_id"], d["source"], d["text"]) for d in rows(sf_dir, "documents")]
    place = keys(spark, docs)
    got = found(queries.op8_fair_queueing(spark, sf_dir))
    close(got, mixed(docs, lambda d: place[d]))


def test_sources_come_near_their_targets(spark, sf_dir):
    got = queries.op8_fair_queueing(spark, sf_dir)
    source = {d["doc_id"]: d["source"] for d in rows(sf_dir, "documents")}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in as_dicts(got):
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        target[s] = r["target"]
        largest[s] = max(largest[s], r["size"])
        assert r["taken"] <= 2 * r["size"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 2 * max(largest.values())


def test_defined_cases(spark):
    docs = [(1, "a", "x " * 9), (2, "a", None), (3, None, "y z"), (4, None, ""), (None, "b", "q " * 5),
            (None, "b", "r " * 5), (5, "é", "w " * 30), (6, "é", "v " * 11), (7, "z", None)]
    df = spark.createDataFrame([(*d, 1) for d in docs],
                               "doc_id long, source string, text string, size int")
    place = keys(spark, docs)
    close(found(mixing.mix(df.drop("size"))), mixed(docs, lambda d: place[d]))
    assert mixing.mix(df.limit(0)).count() == 0
    only_empty = df.where("text IS NULL")
    assert {r["taken"] for r in as_dicts(mixing.mix(only_empty))} == {0}


def test_documents_come_as_often_as_they_are_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for r in as_dicts(queries.op8_fair_queueing(spark, sf_dir)):
        assert copies.get(r["doc_id"], 0) * r["size"] == r["taken"]


def test_running_sum_over_many_ranges(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = mixing.running_sum(df, ["k"], "v", "s").orderBy("k").collect()
    total = 0
    for r in got:
        total += r.v
        assert r.s == total
