import zipfile

import pytest
from brute import as_dicts, base_spans, rows, sha256

from tripmill.llm import common, queries, secrets

KINDS = ("assign", "access", "hex")


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_of_every_document(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables hold no secret
    got = {r["doc_id"]: r for r in as_dicts(queries.op5_guess_cost(spark, sf_dir))}
    some = 0
    for d in rows(sf_dir, "documents"):
        want, row = base_spans(d["text"]), got[d["doc_id"]]
        assert row["base_sha256"] == sha256(joined(want))
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[1] == i for s in want) for i in range(3)]
        assert set(filter(None, joined(want).split(","))) <= set(row["spans"].split(","))
        some += bool(want)
    assert some and len(got) == len(rows(sf_dir, "documents"))


ODD = [None, "", "secret: token: abcdef1", "PASSWORD = 'aaaaaa'", "token=abc", "ſecret=abcdef",
       "api_key:x-._=/+yz", "apikey\"  :  \"1234567", "AKIA" + "Q" * 16, "AKIAAKIA" + "Z" * 15,
       "xAKIA" + "9" * 15, "f" * 23, "e" * 24 + "g", "F" * 30, "é token=ünïcode token=ascii1",
       "token=" + "a" * 50_000, "0123456789abcdef" * 4000, "passwordpassword=abcdefg"]


def test_odd_texts(spark):
    data = [(i, t, "s") for i, t in enumerate(ODD)] + [(None, "token=abcdef", "s")] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, spans string")
    for r in as_dicts(secrets.scan(docs)):
        text = "token=abcdef" if r["doc_id"] is None else ODD[r["doc_id"]]
        assert r["base_spans"] == joined(base_spans(text)), text
    assert secrets.scan(docs).count() == len(data) and secrets.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize("weak,strong", [
    ("password123", "x9#Lq2!vBz7"), ("2024-01-31", "8f3kq0zt1w"), ("qwertyuiop", "qpwoeiruty"),
    ("aaaaaaaaaaaa", "ajdkslfhgnvb"), ("abcabcabcabc", "abzqcpbkaxcy"), ("P@ssw0rd", "Pk#sv0xq")])
def test_guessable_values_cost_less(weak, strong):
    assert secrets.log10_guesses(weak) < 10 < secrets.log10_guesses(strong)


def all_segmentations(value):
    """The least cost by trying every segmentation."""
    if not value:
        return 0.0
    best = secrets._character(value[0]) + all_segmentations(value[1:])
    for end, cost in secrets._segments(value, 0):
        best = min(best, cost + secrets._JOIN + all_segmentations(value[end:]))
    return best


@pytest.mark.parametrize("value", ["", "a", "pass1", "admin99", "zzzx12", "1qazroot", "2001-05-06q"])
def test_programme_finds_the_least_cost(value):
    assert secrets.log10_guesses(value) == pytest.approx(all_segmentations(value))


def test_method_adds_contexts_and_long_values_end():
    assert secrets.guessed_spans("login: https://bob:g7#kQ2!zXw9@host/", 10)
    assert secrets.guessed_spans("the password is kX9#fmQ2vT!", 10)
    assert not secrets.guessed_spans("the password is changeme", 10)
    assert secrets.log10_guesses("x7" * 3000) < secrets.log10_guesses("k0" + "x7" * 3000) < 1000


def test_redaction_leaves_no_span_and_the_rest(spark):
    docs = spark.createDataFrame([(1, "a password=hunter2x b", 3), (2, None, 4), (3, "clean", 5)],
                                 "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: r for r in as_dicts(secrets.redact(docs))}
    assert got[1]["text"] == "a [secret] b" and got[2]["text"] is None
    assert got[3]["text"] == "clean" and got[3]["n_chars"] == 5


@pytest.mark.parametrize("text", [
    "Your password is incorrect", "the secret is patience", "The password is required.",
    "Each token is represented by a number", "The credential is unauthorized", "password: required",
    "A token is authenticated here", "the secret is misunderstandings", "Passphrase is misconfigured",
    "a basic understanding", "Basic responsibilities", "password is case-sensitive"])
def test_prose_after_a_context_is_clean(text):
    assert not secrets.guessed_spans(text, secrets.MIN_LOG10_GUESSES)


def test_prose_is_clean_and_secrets_are_not_in_spark(spark):
    docs = spark.createDataFrame([(1, "Your password is incorrect, the secret is patience"),
                                  (2, "the password is kX9#fmQ2vT7")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in as_dicts(secrets.redact(docs))}
    assert got[1]["text"] == "Your password is incorrect, the secret is patience"
    assert got[2]["text"] == "the password is [secret]"


def test_the_word_list_goes_to_the_workers(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(common, "_sent", set())
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: sent.append(path))
    common.send_package(spark)
    assert "tripmill/llm/words.txt" in zipfile.ZipFile(sent[0]).namelist()


@pytest.mark.parametrize("value", ["*" * 120, "*" * 200, "*" * 5000, "x" * 200, "x" * 5000, "ab1" * 1700,
                                   "qw" * 2500])
def test_masks_of_any_length_are_guessable(value):
    assert secrets.log10_guesses(value) < secrets.MIN_LOG10_GUESSES
    assert not secrets.guessed_spans(f"Password: {value}", secrets.MIN_LOG10_GUESSES)


def test_a_higher_bound_looks_at_longer_units():
    unit = "x7Kq2!vBz9#Lm4Wt8@Rp5"
    assert secrets.log10_guesses(unit * 100, 40) < 35
    assert secrets.log10_guesses(unit * 100) >= secrets.MIN_LOG10_GUESSES
    for value in ["a1a1a1a1", "zzzabab", "Xy7Xy7Xy7a", "abcabcab"]:
        assert secrets.log10_guesses(value) == pytest.approx(all_segmentations(value))
