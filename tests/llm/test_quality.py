import math

import pytest
from brute import as_dicts, quality_counts, rows
from compare import differences, duck

from tripmill.llm import oracles, quality, queries

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_of_every_document(spark, sf_dir):
    got = {r["doc_id"]: r for r in as_dicts(queries.op3_distribution_divergence(spark, sf_dir))}
    docs = rows(sf_dir, "documents")
    assert len(got) == len(docs)
    for d in docs:
        row, want = got[d["doc_id"]], quality_counts(d["text"])
        assert tuple(row[c] for c in COUNTS) == want
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row["kept"] and row["base_failed"])


def test_equals_sql(spark, sf_dir):
    assert differences(queries.op3_distribution_divergence(spark, sf_dir), duck(sf_dir),
                       oracles.all_sql()["op3_distribution_divergence"]) == []


ODD = [None, "", " \t\n", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "é́ 中 文",
       "\x1c\x85\xa0 a", "a\r\na\r\na", "#" * 500, "word " * 3000, " ".join(map(str, range(30_000)))]


def test_odd_texts(spark):
    docs = [(i, t, None, 7) for i, t in enumerate(ODD)] + [(None, "a b", "xx", 7)] * 2
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, n_words int")
    for r in as_dicts(quality.quality_rules(df)):
        text = "a b" if r["doc_id"] is None else ODD[r["doc_id"]]
        assert tuple(r[c] for c in COUNTS) == quality_counts(text), text
    assert quality.quality_rules(df).count() == len(docs)
    assert quality.quality_rules(df.limit(0)).count() == 0


@pytest.mark.parametrize("text", ODD)
def test_exact_form_agrees_with_the_quick_one(spark, text):
    words = "regexp_extract_all(text, '([^\\\\x20\\\\x09-\\\\x0D]+)')"
    df = spark.createDataFrame([(text or "",)], "text string").selectExpr(f"{words} AS w")
    exact = df.selectExpr("CASE WHEN size(w) < 3 THEN 0L ELSE "
                          + quality.repeated_window_words("w", exact=True) + " END").first()[0]
    assert exact == quality_counts(text)[4]


def test_divergence_is_that_of_the_definition(spark):
    from pyspark.sql import functions as F

    counts, shares = [3, 0, 1], [0.5, 0.5, 0.0]
    got = spark.range(1).select(quality.divergence(
        F.array(*map(F.lit, counts)), shares, F.lit(4.0))).first()[0]
    p = [c / 4 for c in counts]
    m = [(a + b) / 2 for a, b in zip(p, shares)]
    want = sum(a * math.log2(a / c) for d in (p, shares) for a, c in zip(d, m) if a) / 2
    assert got == pytest.approx(want)


def test_junk_goes_and_prose_stays(spark, sf_dir):
    docs = {d["doc_id"]: d for d in rows(sf_dir, "labels")}
    got = [r for r in as_dicts(queries.op3_distribution_divergence(spark, sf_dir))
           if r["doc_id"] in docs and not r["base_failed"]]
    good = [r["kept"] for r in got if docs[r["doc_id"]]["quality"] == 1]
    junk = [r["kept"] for r in got if docs[r["doc_id"]]["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(junk) <= 0.1 * len(junk)
