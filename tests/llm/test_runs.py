import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import as_dicts, rows, sha256, words

from tripmill.llm import queries, runs


def plain_runs(x):
    """All runs by every lag and every start."""
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            length = i - a + q
            shorter = any(q % d == 0 and all(x[k] == x[k + d] for k in range(a, a + length - d))
                          for d in range(1, q))
            if length >= max(6, 4 * q) and not shorter:
                out.append((a, length, q))
    return sorted(out)


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]


def plain(doc_id, w):
    found = plain_runs(w)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    told = "".join(f"{a},{n},{q}\n" for a, n, q in found)
    start, length, period = best or (None, None, None)
    milli = 1000 * length // period if best else None
    return doc_id, len(found), start, length, period, milli, sha256(told), sha256(kept)


def test_every_document_against_every_lag(spark, sf_dir):
    short = [d for d in rows(sf_dir, "documents") if len(words(d["text"])) < 1500]
    got = {r["doc_id"]: r for r in as_dicts(queries.op12_multiscale_minimizers(spark, sf_dir))}
    assert len(short) > 100
    for d in short:
        r = got[d["doc_id"]]
        assert (d["doc_id"], r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"],
                r["runs_sha256"], r["collapsed_sha256"]) == plain(
            d["doc_id"], planted(d["doc_id"], words(d["text"])))
    assert any(r["n_runs"] > 0 for r in got.values())


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_random_sequences(letters):
    rng = random.Random(letters)
    met = set()
    for _ in range(250):
        n = rng.randint(0, 250)
        x = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 8:
                a = rng.randrange(n)
                p, end = 1 + (n - a) // rng.randint(3, 11), rng.randint(a, n)
                x[a:end] = [x[a + i % p] for i in range(end - a)]
        want = plain_runs(x)
        assert runs.find_runs(np.array(x, np.int64)) == want
        met |= {r[2] for r in want}
    assert max(met) > 2 * runs.DIRECT or letters == 1


def test_long_periods_of_every_scale():
    rng = np.random.default_rng(1)
    for period in (8, 9, 16, 17, 31, 32, 33, 100, 1000, 4097):
        before, unit = rng.integers(0, 10 ** 6, 77), rng.integers(0, 10 ** 6, period)
        x = np.concatenate([before, np.tile(unit, 5)[:4 * period + 1], rng.integers(0, 10 ** 6, 50)])
        assert runs.find_runs(x) == [(77, 4 * period + 1, period)]


def test_defined_cases(spark):
    texts = [(1, None), (2, ""), (3, " \n\t"), (4, "a " * 5), (5, "a " * 6), (None, "a b " * 4),
             (None, "a b " * 4), (7, "x y z " * 40_000), (8, "a a " * 6)]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, `a.b` int")
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
           for r in runs.periodic_runs(df).collect()]
    key = repr
    assert sorted(got, key=key) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 5, [], "a a a a a"), (5, 6, [(0, 6, 1)], "a"),
        (None, 8, [(0, 8, 2)], "a b"), (None, 8, [(0, 8, 2)], "a b"),
        (7, 120_000, [(0, 120_000, 3)], "x y z"), (8, 6, [(0, 6, 1)], "a a")], key=key)
    assert runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(df.withColumnRenamed("a.b", "Runs"))


def test_equal_exponents_take_the_first_start():
    assert runs.strongest_of([(0, 8, 2), (9, 8, 2), (20, 4, 1)]) == (0, 8, 2)
    assert runs.strongest_of([(0, 8, 2), (9, 9, 2)]) == (9, 9, 2)
    assert runs.strongest_of([]) is None


def test_hash_of_nothing(spark):
    df = spark.createDataFrame([(3, "")], "doc_id long, text string")
    assert hashlib.sha256(b"").hexdigest() == sha256(runs.periodic_runs(df).first()["collapsed"])
