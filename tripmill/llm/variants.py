"""Spelling variants by FM-index search schemes over a delimited vocabulary.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. One edit
leaves one half of a word as it is: with l the length of the shorter word, either the first l // 2 code
points of both are equal or the last l - l // 2. The two search schemes follow from that: match one half
exactly, starting at the delimiter at its end, then extend across the other half, allowing one error,
until the delimiter at the far end. The first half is matched in the index of the reversed words, the
second in the index of the words as they are, which are the two directions of a bidirectional index; as
every search begins at a delimiter, it needs only one of them.

The vocabulary is dealt out by halves. A word of length l belongs to the groups of its halves for
l (there it also asks) and for l - 1 (there it is only found, by words that are one shorter), so each
near pair shares a group, and a task gets whole groups of about ``SHARD_WORDS`` words together. A group of
more than ``GROUP_WORDS`` words is dealt again by the halves of what its words do not share, of which
one edit again leaves one as it is. A task writes its words behind delimiters, sorts the suffixes, and
searches for all words at once: a state is an interval of suffix ranks, and a step narrows all intervals
by one code point with two rank look-ups. Delimited words are sorted, so the rank of a found one is
its number. No two words are compared with each other.

Forms need a count that is ``least_ratio`` times as large at every step, so chains of forms are
short; their ends are found by following twice as many steps each round.

Defined cases: words that are null or empty, or whose n is null, are left out; of repeated words the n
are summed; a word without a near one, or whose near ones are too rare, has no form and is its own
root; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import for_python, written
from tripmill.session import fresh_folder

# --- parameters -------------------------------------------------------------------------------------
#: A-Z, a-z and the letters of Latin-1 with the two signs among them.
LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
LEAST_RATIO = 5
SHARD_WORDS = 8_192   # words of a task, about
GROUP_WORDS = 4_096   # words that share a half, beyond which they are dealt again
STEP = 16             # places between stored ranks
FEW = 16              # places of an interval whose symbols are read one by one

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- the index ---------------------------------------------------------------------------------------

def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by sorting prefixes of doubled length."""
    rank, n, span = text.astype(np.int64), len(text), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-span or None] = rank[span:] + 1
        key = rank * (rank.max() + 2) + ahead
        order = np.argsort(key, kind="stable")
        first = np.ones(n, np.int64)
        first[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(first) - 1
        if rank[order[-1]] == n - 1:
            return order
        span *= 2


class Index:
    """Ranks over the last column of the sorted suffixes of ``|word|word|...|``.

    Symbol 0 ends the text, symbol 1 delimits words, the others are code points in their order.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(words)
        points = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(w) for w in self.words], np.int64)
        self.alphabet, symbols = np.unique(points, return_inverse=True)
        ends = np.cumsum(lengths + 1)
        text = np.ones(int(ends[-1]) + 2, np.int64)
        text[-1] = 0
        here = np.ones(len(text), bool)
        here[0] = here[-1] = False
        here[ends] = False
        text[here] = symbols + 2
        order = suffix_order(text)
        last = text[order - 1]
        self.n, self.kinds = len(text), len(self.alphabet) + 2
        rows = -(-self.n // STEP) + 1
        self.last = np.full(rows * STEP, -1, np.int64)
        self.last[:self.n] = last
        self.blocks = self.last.reshape(rows, STEP)
        counts = np.zeros((self.kinds, rows + 1), np.int32)
        at = np.arange(self.n) // STEP + 1
        np.add.at(counts, (last, at), 1)
        self.stored = np.cumsum(counts, axis=1, dtype=np.int32)
        self.smaller = np.append(0, np.cumsum(np.bincount(text, minlength=self.kinds)))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often symbols stand before places of the last column."""
        row = place // STEP
        within = np.arange(STEP) < (place % STEP)[:, None]
        inside = (self.blocks[row] == symbol[:, None]) & within
        return self.stored[symbol, row] + np.count_nonzero(inside, axis=1)

    def extend(self, symbol: np.ndarray, low: np.ndarray,
               high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of what was matched with a symbol put before it."""
        base = self.smaller[symbol]
        return base + self.rank(symbol, low), base + self.rank(symbol, high)

    def symbols_before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(state, symbol), each once: the code points that stand before what was matched."""
        size = high - low
        few, many = np.flatnonzero(size <= FEW), np.flatnonzero(size > FEW)
        state = np.repeat(few, size[few])
        place = np.arange(len(state)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
        symbol = self.last[low[state] + place]
        both = np.unique(state * self.kinds + symbol)
        state, symbol = both // self.kinds, both % self.kinds
        every = np.repeat(many, self.kinds)
        each = np.tile(np.arange(self.kinds), len(many))
        state, symbol = np.append(state, every), np.append(symbol, each)
        return state[symbol > 1], symbol[symbol > 1]

    def near(self, exact: dict[str, int]) -> list[tuple[str, str]]:
        """(word, near word) for words of which as many code points at the end are as given, the near
        one as long or one longer."""
        asking = sorted(exact)
        lengths = np.array([len(w) for w in asking], np.int64)
        least = np.array([exact[w] for w in asking], np.int64)
        # Row per word, read from its end; after the first code point comes the delimiter.
        turned = np.ones((len(asking), int(lengths.max()) + 1), np.int64)
        places = np.searchsorted(self.alphabet, np.frombuffer(
            "".join(w[::-1] for w in asking).encode("utf-32-le"), np.uint32)) + 2
        turned[np.arange(turned.shape[1]) < lengths[:, None]] = places

        ask, read = np.arange(len(asking)), np.zeros(len(asking), np.int64)
        wrong = np.zeros(len(asking), bool)
        low = np.full(len(asking), self.smaller[1])
        high = np.full(len(asking), self.smaller[2])
        found_ask, found_place = [], []
        while len(ask):
            # One error here: another code point in place of the next one, or one put before it.
            may = np.flatnonzero(~wrong & (read >= least[ask]))
            state, symbol = self.symbols_before(low[may], high[may])
            state = may[state]
            own = turned[ask[state], read[state]]
            replaced = (own != symbol) & (own != 1)
            branch = np.append(state[replaced], state)
            put = np.append(symbol[replaced], symbol)
            moved = np.append(np.ones(replaced.sum(), np.int64), np.zeros(len(state), np.int64))
            # Without an error: the next code point, or the delimiter, which ends a search.
            following = turned[ask, read]
            on = np.flatnonzero(wrong | (following != 1))
            ended = wrong[on] & (following[on] == 1)
            state = np.concatenate([on, branch])
            put = np.append(following[on], put)
            low, high = self.extend(put, low[state], high[state])
            ask, read = ask[state], read[state] + np.append(np.ones(len(on), np.int64), moved)
            wrong = np.append(wrong[on], np.ones(len(branch), bool))
            there = high > low
            ended = np.append(ended, np.zeros(len(branch), bool))
            done = there & ended
            found_ask.append(ask[done])
            # Rank among the delimiters: the one at the end of the text comes first.
            found_place.append(low[done] - self.smaller[1] - 1)
            left = there & ~ended
            ask, read, wrong, low, high = ask[left], read[left], wrong[left], low[left], high[left]
        pairs = zip(np.concatenate(found_ask), np.concatenate(found_place))
        return sorted({(asking[a], self.words[b]) for a, b in pairs if asking[a] != self.words[b]})


def near_in(words: list[str], exact: dict[str, int], reverse: bool) -> list[tuple[str, str]]:
    """Near pairs of words that ask; the part that is matched exactly is at the front if reversed."""
    if not reverse:
        return Index(words).near(exact)
    pairs = Index([w[::-1] for w in words]).near({w[::-1]: n for w, n in exact.items()})
    return [(a[::-1], b[::-1]) for a, b in pairs]


# ---- dealing out -------------------------------------------------------------------------------------

def _halves(words: DataFrame) -> DataFrame:
    """A row per word, side and role: ``turned`` is the word with the matched half at its end."""
    length = F.length("word")
    roles = F.explode(F.array(*[
        F.struct(F.lit(front).alias("front"), F.lit(asks).alias("asks"),
                 (length - (0 if asks else 1)).alias("base"))
        for front in (True, False) for asks in (True, False)]))
    rows = words.select("word", roles.alias("r")).select("word", "r.*").where("base > 0")
    half = F.floor(F.col("base") / 2).cast("int")
    turned = F.when(F.col("front"), F.reverse("word")).otherwise(F.col("word"))
    return rows.withColumn("turned", turned).withColumn(
        "exact", F.when(F.col("front"), half).otherwise(F.col("base") - half)).withColumn(
        "key", _key("front", "base", F.right("turned", F.col("exact"))))


def _key(*parts) -> Column:
    return F.concat_ws(" ", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])


def _dealt_again(rows: DataFrame) -> DataFrame:
    """Large groups by the halves of what their words do not share."""
    rest = F.col("base") - F.col("exact")
    beside = rest - F.floor(rest / 2).cast("int")
    open_part = F.left("turned", F.length("turned") - F.col("exact"))
    kinds = F.array(F.struct(F.lit("beside").alias("kind"), F.right(open_part, beside).alias("part")),
                    F.struct(F.lit("ahead").alias("kind"),
                             F.left(open_part, F.floor(rest / 2).cast("int")).alias("part")))
    return rows.withColumn("k", F.explode(kinds)).withColumn(
        "key", _key("key", "k.kind", F.col("k.part"))).drop("k")


def near_pairs(words: DataFrame) -> DataFrame:
    """Both directions (word, near) of all near pairs of the distinct non-empty words."""
    spark = words.sparkSession
    for_python(spark)
    # Spark's left and right give an empty text for lengths below one, as is meant here.
    rows = written(_halves(words), fresh_folder(spark, "halves"))
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP_WORDS)
    large = written(large, fresh_folder(spark, "large-groups"))
    if not large.isEmpty():
        again = _dealt_again(rows.join(large, "key", "left_semi"))
        rows = rows.join(large, "key", "left_anti").unionByName(again)
    total = rows.count()
    shards = max(1, math.ceil(total / SHARD_WORDS))

    def search(shard: pd.DataFrame) -> pd.DataFrame:
        front = bool(shard["front"].iloc[0])
        asks = shard[shard["asks"]]
        if not len(asks):
            return pd.DataFrame({"word": [], "near": []}, dtype=object)
        exact = asks.groupby("word")["exact"].min().to_dict()
        pairs = near_in(shard["word"].unique().tolist(), exact, front)
        return pd.DataFrame(pairs + [(b, a) for a, b in pairs], columns=["word", "near"], dtype=object)

    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    return rows.withColumn("shard", shard).select(
        "front", "shard", "word", "asks", "exact").groupBy("front", "shard").applyInPandas(
        search, "word string, near string").distinct()


# ---- forms and roots ---------------------------------------------------------------------------------

def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last, twice as many steps a round."""
    spark = forms.sparkSession
    at = written(forms.select("word", F.col("form").alias("root")), fresh_folder(spark, "roots"))
    while True:
        on = at.alias("a").join(at.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"),
            F.col("b.root").isNotNull().alias("moved"))
        on = written(on, fresh_folder(spark, "roots"))
        if on.where("moved").isEmpty():
            return on.select("word", "root")
        at = on.select("word", "root")


def grouped(counts: DataFrame, least_ratio: int = LEAST_RATIO) -> DataFrame:
    """Per word of (word, n): its form, root, n, how many near words it has, and the form's n."""
    spark = counts.sparkSession
    words = counts.where((F.length("word") > 0) & F.col("n").isNotNull()).groupBy("word").agg(
        F.sum("n").cast("long").alias("n"))
    words = written(words, fresh_folder(spark, "words"))
    pairs = near_pairs(words.select("word"))
    of_near = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = pairs.join(of_near, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best"))
    judged = words.join(best, "word", "left")
    is_form = -F.col("best.minus_n") >= least_ratio * F.col("n")
    judged = written(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.minus_n")).cast("long").alias("form_n")),
        fresh_folder(spark, "forms"))
    roots = roots_of(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def runs_of_letters(docs: DataFrame) -> DataFrame:
    """(doc_id, run) of whole texts, A-Z lower-cased."""
    runs = F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0)))
    return docs.select("doc_id", runs.alias("run")).select(
        "doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def counted(words: DataFrame, least_length: int = LEAST_LENGTH,
            least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of long words that occur often enough; partial sums reach the shuffle."""
    return words.where(F.length("word") >= least_length).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def misspelt(runs: DataFrame, every: int = 199) -> DataFrame:
    """(word): runs of which some, by a checksum of document and run, lose one code point. A null
    doc_id counts as an empty one."""
    mark = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(mark.cast("binary"))
    place = (h % F.length("run")).cast("int")
    without = F.concat(F.left("run", place), F.substr("run", place + 2))
    return runs.withColumn("_h", h).select(
        F.when(F.col("_h") % every == 0, without).otherwise(F.col("run")).alias("word"))
