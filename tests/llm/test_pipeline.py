"""Each stage against a plain version, on what the stage before kept."""

import hashlib

import pandas as pd
import pytest
import sentencepiece
from brute import as_dicts, groups, mixed

import corpus_pipeline as P
from tripmill.llm import langid, mixing, pieces, queries, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The tables before and after every stage."""
    tables = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, tables[-1], SF).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in as_dicts(df)]


def test_stages_keep_the_columns(kept):
    for table in kept[1:-1]:
        assert table.dtypes == kept[0].dtypes


def test_language_keeps_what_is_clear(spark, kept):
    network = langid.train(kept[0])
    clear = []
    for r in as_dicts(kept[0]):
        text = r["text"]
        if text and any(map(str.isalpha, text)):
            _, score = network.judge([text.encode()])[0]
            if score >= P.MIN_LANGUAGE_SCORE:
                clear.append(r["doc_id"])
    assert sorted(r["doc_id"] for r in as_dicts(kept[1])) == sorted(clear)
    assert len(clear) >= 0.95 * kept[0].count()


def test_one_document_of_each_group_stays(kept):
    want = [g[0] for g in groups(pairs(kept[1]), P.SHINGLE) if g[3] or g[1] == 0]
    assert sorted(i for i, _ in pairs(kept[2])) == sorted(want)


def test_secrets_are_marked_and_nothing_else_changes(kept):
    before, after = dict(pairs(kept[2])), dict(pairs(kept[3]))
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        spans = sorted({*secrets.base_spans(text),
                        *secrets.guessed_spans(text, secrets.MIN_LOG10_GUESSES)})
        if not spans:
            assert after[doc_id] == text
        for start, _, end in spans:
            assert text[start:end] not in after[doc_id] or text.count(text[start:end]) > 1
    assert all(r["n_chars"] == len(r["text"]) for r in as_dicts(kept[3]))


def test_mix_takes_each_document_as_often_as_planned(kept):
    rows = as_dicts(kept[3].withColumn("key", mixing.queue_key()))
    docs = [(r["doc_id"], r["source"], r["text"]) for r in rows]
    key = {r["doc_id"]: r["key"] for r in rows}
    copies = [r["doc_id"] for r in as_dicts(kept[4])]
    for doc_id, size, _, _, taken in mixed(docs, lambda d: key[d[0]]):
        assert copies.count(doc_id) * size == taken


def test_encoded_as_the_library_does(kept):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    texts = dict(pairs(kept[4]))
    rows = as_dicts(kept[5])
    assert len(rows) == kept[4].count()
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_run_is_the_stages(spark, kept):
    got = sorted((r["doc_id"], r["n_tokens"]) for r in as_dicts(P.run(spark, SF)))
    assert got == sorted((r["doc_id"], r["n_tokens"]) for r in as_dicts(kept[-1]))


def test_odd_rows_and_an_empty_table_go_through(spark, tmp_path):
    docs = spark.createDataFrame(
        [(None, None, None, None, None, 1), (1, "", "en", None, 0, 1), (2, "12 34", "en", "a", 5, 1),
         (3, "the of and to in " * 9, "en", "a", 1, 1), (3, "the of and to in " * 9, "en", "a", 1, 1),
         (4, "der die und das ist " * 9, "de", None, 1, 1), (None, "the of it is to " * 7, "en", "b", 1, 1),
         (5, "la de que el en " * 20_000, "es", "b", 1, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, size int")
    for n, table in enumerate((docs, docs.limit(0))):
        for name, stage in P.STAGES:
            path = str(tmp_path / f"{n}-{name}")
            stage(spark, table, SF).write.parquet(path)
            table = spark.read.parquet(path)
        assert (table.count() > 0) == (n == 0)


CLASHING = ("Score lang_pred _found size _key target source_size _copies _copy component _rows _hash kept row key "
            "wordless text_hash ids n_tokens _told decoded starts ends spans _row2 _at _word _bits _own_hash "
            "n_shingles set_id component_id _spans `a.b`").split()


def test_columns_that_operators_use_come_out_unchanged(spark, tmp_path):
    """Every stage keeps the values of columns whose names the operators use themselves."""
    names = [c.strip("`") for c in CLASHING]
    texts = ["the of and to in is that for with " * 9 + str(i) for i in range(6)]
    texts += [texts[0], "der die und das ist nicht mit " * 9, "my password is hunter2zq9XkQ and more of it"]
    rows = [(i, t, "de" if "der" in t else "en", "ab"[i % 2], len(t), *[f"{c}-{i}" for c in names])
            for i, t in enumerate(texts)]
    fields = "doc_id long, text string, lang string, source string, n_chars long, "
    docs = spark.createDataFrame(rows, fields + ", ".join(f"`{c}` string" for c in names))
    for name, stage in P.STAGES[:-1]:
        path = str(tmp_path / name)
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        got = docs.collect()
        assert got
        for r in got:
            assert all(r[c] == f"{c}-{r['doc_id']}" for c in names), (name, r)
    assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_the_last_stage_decodes_the_ids_it_returns(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    seen = []
    decode = pieces.PieceModel.decode
    monkeypatch.setattr(pieces.PieceModel, "decode",
                        lambda self, ids: seen.append(list(ids)) or decode(self, ids))
    got = pieces._teller(pieces.read_model(queries.piece_model()), True).func(pd.Series(["a 中文", None]))
    assert seen == [ids.tolist() for ids in got["ids"]] == [library.encode("a 中文"), []]
