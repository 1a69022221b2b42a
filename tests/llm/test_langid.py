import zlib

import numpy as np
from brute import as_dicts, network_odds, rows

from tripmill.llm import langid, queries


def test_held_out_documents_are_told(spark, sf_dir):
    docs = {d["doc_id"]: d for d in rows(sf_dir, "documents")}
    got = as_dicts(queries.op6_byte_network(spark, sf_dir))
    assert len(got) == len(docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    tested = [r for r in got if r["held_out"] and docs[r["doc_id"]]["lang"]]
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in tested]
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)


def test_reruns_agree_and_labels_are_no_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = langid.train(docs)
    a = langid.identified(docs.select("doc_id", "text"), network).collect()
    b = langid.identified(docs.select("doc_id", "text"), langid.train(docs.repartition(5))).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in a) == sorted((r.doc_id, r.lang_pred) for r in b)


def test_defined_cases(spark):
    texts = [None, "", "12 34 !?", "der die und das " * 40, "the of and to " * 40, "x" * 200_000]
    data = [(i, t, "de" if i % 2 else "en", "z") for i, t in enumerate(texts)]
    data += [(None, "the of and", "en", "z")] * 2 + [(90 + i, "the of and to", None, "z")
                                                     for i in range(2)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score string")
    got = as_dicts(langid.identify(docs))
    assert len(got) == len(data)
    for r in got:
        if r["doc_id"] in (0, 1, 2):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        if r["doc_id"] is None:
            assert r["held_out"]
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in as_dicts(langid.identify(unlabelled))} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    network = langid.ByteNetwork(["a", "b"], langid.Settings(window=12, filters=3, embedding=4))
    for name, value in network.weights.items():
        network.weights[name] = rng.normal(0, 0.5, value.shape)
    windows, labels = rng.integers(1, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 0, 1, 1])

    def loss():
        pooled = np.hstack([network._answers(windows, w).max(axis=1) + network.weights[f"bias{w}"]
                            for w in network.settings.widths])
        odds = langid.softmax(np.maximum(pooled, 0) @ network.weights["out"]
                              + network.weights["out_bias"])
        return -np.log(odds[np.arange(5), labels]).mean()

    for name, gradient in network._gradients(windows, labels).items():
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = network.weights[name][place]
        network.weights[name][place] = kept + 1e-5
        up = loss()
        network.weights[name][place] = kept - 1e-5
        down = loss()
        network.weights[name][place] = kept
        assert abs((up - down) / 2e-5 - gradient[place]) < 1e-3, name


def test_pair_tables_and_windows_agree_with_the_plain_network():
    settings = langid.Settings(window=16)
    network = langid.ByteNetwork(["a", "b", "c"], settings)
    network.weights["out"] = np.random.default_rng(2).normal(
        0, 1, network.weights["out"].shape).astype("float32")
    text = bytes(range(1, 200))
    windows = langid.cut(text, 16, 3)
    assert windows[0].tobytes() == text[:16] and text.endswith(windows[-1].tobytes().rstrip(b"\0"))
    assert len(windows) == -(-(len(text) - 3) // 13)
    pooled = np.hstack([network._answers(windows, w).max(axis=1) for w in settings.widths])
    plain = langid.softmax(np.maximum(pooled, 0) @ network.weights["out"])
    assert np.allclose(np.exp(network.log_odds(windows)), plain, atol=1e-4)


def test_forward_pass_against_a_plain_one():
    rng = np.random.default_rng(8)
    settings = langid.Settings(window=14, filters=3, embedding=4)
    network = langid.ByteNetwork(["a", "b", "c"], settings)
    for name, value in network.weights.items():
        network.weights[name] = rng.normal(0, 0.7, value.shape).astype("float32")
    windows = rng.integers(0, 256, (6, 14)).astype(np.uint8)
    got = np.exp(network.log_odds(windows))
    want = [network_odds(network.weights, settings.widths, w.tolist()) for w in windows]
    assert np.allclose(got, want, atol=1e-4)


def test_no_text_is_shuffled_for_the_sample(spark, monkeypatch):
    """What goes into the aggregate and the ranking is cut to windows before."""
    import pandas as pd
    docs = spark.range(60).selectExpr("id AS doc_id", "repeat('the of ', 5000) AS text", "'en' AS lang")
    seen = {}

    def kept(self):
        seen["plan"] = self._jdf.queryExecution().executedPlan().toString()
        return pd.DataFrame({"lang": [], "part": []})

    monkeypatch.setattr(type(docs), "toPandas", kept)
    langid.training_windows(docs)
    for line in seen["plan"].split("\n"):
        if "Exchange" in line and "Broadcast" not in line:
            assert "text#" not in line


def test_sample_is_bounded_and_equal_rows_are_one(spark):
    docs = spark.range(400).selectExpr(
        "id % 4 AS doc_id", "concat('some words of text ', id % 4) AS text", "'en' AS lang")
    assert len(langid.training_windows(docs)) <= 4 * langid.Settings().windows
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('some words ', id) AS text",
                                        "concat('l', id % 3) AS lang")
    small = langid.Settings(max_rows=50, per_language=30)
    assert len(langid.training_windows(many, small)) == 50 * small.windows
