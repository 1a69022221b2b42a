"""Periodic runs in the words of a text, by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at
least ``max(LEAST_WORDS, REPEATS * q)`` words, which no neighbouring word extends keeping that period.

Periods up to ``DIRECT`` are found by direct lag scans: one comparison of the text with itself per lag.
Longer ones are found scale by scale. Scale w, a power of two, is for periods of more than w / 2 and up
to w words. Every block of w words has a hash, and of any w / 2 + 1 neighbouring blocks the one with
the least hash is kept, the leftmost if several are equal. Inside a run of period q the hashes repeat
every q places; as REPEATS is four or more, a window and the one q places further on lie both inside it
and keep blocks q places apart. A block of at least q words occurs once per period, so those two are
neighbours among the kept blocks of that hash, and their distance is the lag. Each such pair is a seed,
extended to both sides by comparing words, so hashes only propose and words decide.

A text takes O(n log n) steps and memory in proportion to its words. Every text is handled whole and by
itself, so rows only flow through; nothing is shuffled.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; rows with equal
or null ids are each judged by their own text; an empty table gives an empty result. Other columns pass
through; a column that has the name of an added one stops the call with an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import WORD, for_python

# --- parameters -------------------------------------------------------------------------------------
LEAST_WORDS = 6
REPEATS = 4
DIRECT = 8            # longest period of the direct scans, a power of two

ADDED = ("n_words", "runs", "strongest", "collapsed")
FOUND = ("n_words long, starts array<long>, lengths array<long>, periods array<long>, "
         "start long, length long, period long, collapsed string")

_U64 = np.uint64
_ODD = _U64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U64(31))) * _U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
        return x ^ (x >> _U64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of blocks from the hashes of their halves."""
    with np.errstate(over="ignore"):
        return _mix(left * _ODD + right)


def kept_blocks(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash of every window of neighbouring blocks, the leftmost of equal ones."""
    least, place, span = hashes, np.arange(len(hashes)), 1
    while span < window:
        step = min(span, window - span)
        right = least[step:] < least[:-step]
        least, place = (np.where(right, least[step:], least[:-step]),
                        np.where(right, place[step:], place[:-step]))
        span += step
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    return place[first]


def seeds(hashes: np.ndarray, block: int) -> np.ndarray:
    """(lag, place) of neighbouring equal kept blocks whose lag belongs to this scale, sorted."""
    kept = kept_blocks(hashes, block // 2 + 1)
    order = np.argsort(hashes[kept], kind="stable")
    places, values = kept[order], hashes[kept][order]
    lags = places[1:] - places[:-1]
    good = (values[1:] == values[:-1]) & (lags > block // 2) & (lags <= block)
    found = np.stack([lags[good], places[:-1][good]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def _equal_ahead(ids: np.ndarray, place: int, lag: int) -> int:
    """How many places from this one on equal those a lag further."""
    most, begin, step = len(ids) - lag, place, 64
    while begin < most:
        end = min(most, begin + step)
        differ = ids[begin:end] != ids[begin + lag:end + lag]
        if differ.any():
            return begin + int(differ.argmax()) - place
        begin, step = end, step * 2
    return most - place


def _equal_behind(ids: np.ndarray, place: int, lag: int) -> int:
    """How many places before this one equal those a lag further."""
    end, step = place, 64
    while end > 0:
        begin = max(0, end - step)
        differ = ids[begin:end] != ids[begin + lag:end + lag]
        if differ.any():
            return place - (begin + len(differ) - int(differ[::-1].argmax()))
        end, step = begin, step * 2
    return place


def _primitive(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether no shorter period holds in a stretch with this one; a shorter one would divide it."""
    for shorter in range(1, period // 2 + 1):
        if period % shorter == 0 and np.array_equal(
                ids[start:start + period], ids[start + shorter:start + period + shorter]):
            return False
    return True


def long_enough(period: int) -> int:
    return max(LEAST_WORDS, REPEATS * period)


def _repeats_enough(hashes: np.ndarray) -> bool:
    """Whether as many blocks of DIRECT words repeat an earlier one as in the least of longer runs."""
    period = DIRECT + 1
    return len(hashes) - len(np.unique(hashes)) >= long_enough(period) - DIRECT + 1 - period


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence of word numbers, by start, then period."""
    n, found = len(ids), []
    for lag in range(1, min(DIRECT, n // REPEATS) + 1):
        same = ids[:-lag] == ids[lag:]
        if np.count_nonzero(same) + lag < long_enough(lag):
            continue
        differ = np.flatnonzero(~same)
        ends = np.append(differ, n - lag)
        starts = np.append(0, differ + 1)
        good = ends - starts + lag >= long_enough(lag)
        found += [(int(a), int(b - a + lag), lag) for a, b in zip(starts[good], ends[good])
                  if _primitive(ids, a, lag)]
    block = 1
    hashes = _mix(ids.astype(_U64) + _U64(1))
    while REPEATS * (block + 1) <= n:  # the next scale's shortest period fits
        hashes = _joined(hashes[:-block], hashes[block:])
        block *= 2
        if block == DIRECT and not _repeats_enough(hashes):
            break
        if block <= DIRECT:
            continue
        reached, at = 0, 0
        for lag, place in seeds(hashes, block):
            if lag != at:
                at, reached = lag, 0
            if place < reached:  # in a stretch that has been extended
                continue
            ahead, behind = _equal_ahead(ids, place, lag), _equal_behind(ids, place, lag)
            reached = place + ahead
            if ahead + behind + lag >= long_enough(lag) and _primitive(ids, place - behind, lag):
                found.append((int(place - behind), int(ahead + behind + lag), int(lag)))
    return sorted((start, length, period) for start, length, period in set(found))


def strongest_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; the first start, then period, of equal ones."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _find():
    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        counts, collapsed, strongest, columns = [], [], [], ([], [], [])
        for text in texts:
            # Bytes split at exactly the six white characters of the word rule.
            words = (text or "").encode("utf-8", "replace").split()
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
            runs = find_runs(ids) if len(number) < len(words) else []
            counts.append(len(words))
            strongest.append(strongest_of(runs) or (None, None, None))
            for column, values in zip(columns, zip(*runs) if runs else ((), (), ())):
                column.append(np.array(values, np.int64))
            if runs:
                words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
            collapsed.append(b" ".join(words).decode("utf-8"))
        best = pd.DataFrame(strongest, columns=["start", "length", "period"], dtype="Int64")
        return pd.DataFrame({
            "n_words": counts, "starts": columns[0], "lengths": columns[1], "periods": columns[2],
            "start": best["start"], "length": best["length"], "period": best["period"],
            "collapsed": collapsed})
    return find


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_words, runs (structs by start, then period), the strongest run (null if there is
    none), and the text whose runs are collapsed to their first period, words joined by one space."""
    clash = [c for c in docs.columns if c.lower() in (*ADDED, "_found")]
    if clash:
        raise ValueError(f"columns {clash} have names of added ones")
    for_python(docs.sparkSession)
    found = docs.select("*", _find()(F.col(f"`{text}`")).alias("_found"))
    zipped = F.arrays_zip("_found.starts", "_found.lengths", "_found.periods")
    best = F.when(F.col("_found.start").isNotNull(), F.struct(
        "_found.start", "_found.length", "_found.period"))
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns], "_found.n_words",
        F.transform(zipped, lambda r: F.struct(
            r["starts"].alias("start"), r["lengths"].alias("length"), r["periods"].alias("period"))).alias("runs"),
        best.alias("strongest"), "_found.collapsed")


def planted(text: Column, doc_id: Column) -> Column:
    """Texts of which a tenth get a period, by a checksum of their id; the others as they are."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    n = F.size(words).cast("long")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    begin = g % F.greatest(n, F.lit(1))
    period = F.lit(1) + F.floor((n - begin) / (F.lit(3) + g % 8)).cast("long")
    one = F.slice(words, (begin + 1).cast("int"), period.cast("int"))
    again = F.flatten(F.array_repeat(one, F.ceil((n - begin) / period).cast("int")))
    made = F.slice(F.concat(F.slice(words, F.lit(1), begin.cast("int")), again), F.lit(1),
                   n.cast("int"))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(text)
