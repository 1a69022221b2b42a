"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(sf_dir: str, name: str) -> list[dict]:
    found = duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'")
    return [dict(zip(found.columns, r)) for r in found.fetchall()]


def as_dicts(df) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def words(text) -> list[str]:
    return WORD.findall(text or "")


def url_verdict(url, hosts, patterns, regex_of):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = [r for r in hosts if (host == r.host or host.endswith("." + r.host))
            and path.startswith(r.path)]
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), url or "")
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    hits = [p for p in patterns if re.search(regex_of(p.removeprefix("@@")), lower, re.DOTALL)]
    blocked = hits and not any(p.startswith("@@") for p in hits)
    return host, path, None, "block" if blocked else "allow"


def top_k(table, picks, k, scale=64):
    """(query, rank, id, score) by all pairs; rows are (id, vector)."""
    usable = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in table
              if i is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for q, a in {(i, tuple(v)) for i, v in usable if picks(i)}:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q)
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(found)


def quality_counts(text):
    w = words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in (i, i + 1, i + 2)}
    seen, doubled = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), doubled,
            len(covered))


def base_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                         r"""([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text)
                  if len(m.group()) >= least]
    return sorted(found)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, size):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def groups(docs, size, percent=80):
    """(id, set size, component, kept) by all pairs; docs are (id, text)."""
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[root(i)] = root(j)
    lowest = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            lowest[root(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        component = min(lowest[root(i)], default=None)
        out.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return out


def mixed(docs, key_of, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    """(id, size, source size, target, taken); docs are (id, source, text), key_of gives the place in
    the queue."""
    sizes = [len(words(t)) for _, _, t in docs]
    of = defaultdict(int)
    for (_, s, _), n in zip(docs, sizes):
        of[s] += n
    order = sorted((s for s in of if s is not None), key=lambda s: [ord(c) for c in s])
    order += [None] if None in of else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, full = share * sum(sizes), set()
    while True:
        left = budget - sum(most * of[s] for s in full)
        open_weight = sum(weight[s] for s in of if s not in full)
        now = {s for s in of if s not in full and left / open_weight * weight[s] > most * of[s]}
        if not now:
            break
        full |= now
        if len(full) == len(of):
            break
    target = {s: float(most * of[s]) if s in full else left / open_weight * weight[s] for s in of}
    queue = []
    for i, s in enumerate(order):
        ahead = 0
        for place in sorted((p for p, d in enumerate(docs) if d[1] == s and sizes[p]),
                            key=lambda p: (key_of(docs[p]), sizes[p], docs[p][0] or 0)):
            ahead += sizes[place]
            queue += [((ahead + e * of[s]) / target[s], i, e, key_of(docs[place]), place)
                      for e in range(most)]
    taken, used = [0] * len(docs), 0
    for *_, place in sorted(queue):
        used += sizes[place]
        if used > sum(target.values()) + 0.25:
            break
        taken[place] += sizes[place]
    return [(d[0], sizes[p], of[d[1]], target[d[1]], taken[p]) for p, d in enumerate(docs)]


def network_odds(weights, widths, window):
    """Probabilities of a byte convolutional network for one window, place by place."""
    pooled = []
    for w in widths:
        kernel, bias = weights[f"filter{w}"], weights[f"bias{w}"]
        for f in range(kernel.shape[2]):
            best = -math.inf
            for start in range(len(window) - w + 1):
                total = 0.0
                for place in range(w):
                    for e, x in enumerate(weights["embedding"][window[start + place]]):
                        total += float(x) * float(kernel[place][e][f])
                best = max(best, total)
            pooled.append(max(best + float(bias[f]), 0.0))
    scores = [sum(p * float(weights["out"][i][k]) for i, p in enumerate(pooled))
              + float(weights["out_bias"][k]) for k in range(len(weights["out_bias"]))]
    powers = [math.exp(s - max(scores)) for s in scores]
    return [p / sum(powers) for p in powers]
