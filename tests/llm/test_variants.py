import random
import re
import zlib
from collections import Counter

import pytest
from brute import as_dicts, rows

from tripmill.llm import queries, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def plain_counts(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def plain_groups(counts):
    """(word, form, root, n, n_near, form_n) by all pairs that share a length."""
    forms, out = {}, []
    of = {w: [u for u in counts if near(w, u)] for w in counts}
    for w, n in counts.items():
        best = min(of[w], key=lambda u: (-counts[u], u), default=None)
        forms[w] = best if best and counts[best] >= 5 * n else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        form = forms[w]
        out.append((w, form, root, n, len(of[w]), counts[form] if form else None))
    return sorted(out)


def told(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
                  for r in as_dicts(df))


def test_counts_of_every_document(spark, sf_dir):
    docs = [(d["doc_id"], d["text"]) for d in rows(sf_dir, "documents")]
    letters = variants.runs_of_letters(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    got = {r["word"]: r["n"] for r in as_dicts(variants.counted(variants.misspelt(letters)))}
    assert got == plain_counts(docs)


def test_every_word_against_all_pairs(spark, sf_dir):
    docs = [(d["doc_id"], d["text"]) for d in rows(sf_dir, "documents")]
    counts = plain_counts(docs)
    got = told(queries.op13_search_schemes(spark, sf_dir))
    assert [(g[0], g[3]) for g in got] == sorted(counts.items())
    some = {g[0]: g for g in got if g[0] in set(random.Random(1).sample(sorted(counts), 300))}
    want = {w[0]: w for w in plain_groups(counts)} if len(counts) < 3000 else None
    for word, row in some.items():
        if want:
            assert row == want[word]
        else:
            assert row[4] == sum(near(word, u) for u in counts)


def crowd(seed=3):
    """Words with misspellings, chains of forms, and many that share a half."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    counts = {}
    for _ in range(60):
        base, n = word(rng.randint(6, 12)), 3000
        for _ in range(rng.randint(1, 4)):
            counts[base] = n
            i = rng.randrange(len(base))
            base = rng.choice((base[:i] + base[i + 1:], base[:i] + rng.choice("abz") + base[i:],
                               base[:i] + rng.choice("abz") + base[i + 1:]))
            n = rng.choice((n, n // 5, n // 4, n // 6)) + 1
    for _ in range(250):
        counts["aaaa" + word(4)] = rng.randint(1, 50)
        counts[word(4) + "bbbb"] = rng.randint(1, 50)
    return counts


@pytest.mark.parametrize("group,shard", [(4096, 8192), (20, 60)])
def test_chains_ties_and_crowded_halves(spark, monkeypatch, group, shard):
    monkeypatch.setattr(variants, "GROUP_WORDS", group)
    monkeypatch.setattr(variants, "SHARD_WORDS", shard)
    counts = crowd()
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert told(variants.grouped(df)) == plain_groups(counts)


def test_index_against_all_pairs():
    rng = random.Random(2)
    for _ in range(60):
        letters = rng.choice(("ab", "abc", "abcdefé🙂"))
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))
                        for _ in range(rng.randint(1, 100))})
        for front in (False, True):
            exact = {w: rng.randint(0, len(w)) for w in words}

            def holds(a, b):
                n = exact[a]
                same = a[:n] == b[:n] if front else a[len(a) - n:] == b[max(0, len(b) - n):]
                return near(a, b) and len(b) >= len(a) and same

            want = sorted((a, b) for a in words for b in words if holds(a, b))
            got = sorted(variants.near_in(words, exact, front))
            # What is matched exactly may also be what an insertion leaves beside it.
            assert set(want) <= set(got) and all(near(a, b) for a, b in got)


def test_defined_cases(spark):
    df = spark.createDataFrame(
        [("abcdef", 3, 0), ("abcdef", 4, 0), ("abcdeg", 35, 0), (None, 5, 0), ("", 5, 0),
         ("alone", None, 0), ("x" * 5000, 9, 0), ("x" * 5001, 9, 0)], "word string, n long, form int")
    assert told(variants.grouped(df)) == sorted([
        ("abcdef", "abcdeg", "abcdeg", 7, 1, 35), ("abcdeg", None, "abcdeg", 35, 1, None),
        ("x" * 5000, None, "x" * 5000, 9, 1, None), ("x" * 5001, None, "x" * 5001, 9, 1, None)])
    assert variants.grouped(df.limit(0)).count() == 0
    docs = spark.createDataFrame([(None, "Straße STRASSE É"), (1, None), (2, ""), (2, "12 ? a")],
                                 "doc_id long, text string")
    assert sorted(r.run for r in variants.runs_of_letters(docs).collect()) == [
        "a", "strasse", "straße", "É"]
