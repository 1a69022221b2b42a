"""Language identification by a byte convolutional network.

Bytes are looked up in a small embedding, filters of several widths slide over a window of fixed
length, the largest answer of each filter is kept, and a softmax layer names the language. The network
is trained here, in numpy, on labelled windows; a text is cut into windows from its first byte to its
last, all are judged in batches, and their log probabilities are averaged by bytes.

Sliding a filter over embedded bytes is a sum of table look-ups, one table per place in the filter. At
prediction two neighbouring places share one table over byte pairs, so a filter of width 4 costs two
look-ups instead of 4 products.

Training reads a bounded, documented sample: the rows with the smallest seeded hash, at most
``per_language`` of a language and ``max_rows`` in all, and ``windows`` windows of each at seeded
places. That sample and the network (a few hundred kB) are all that the driver holds. Prediction reads
whole texts, where they lie, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; rows without language
or id are never learned from, and a missing id counts as held out; without any labelled row all is
``und``; repeated rows are judged alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tripmill.llm.common import for_python

UNDETERMINED = "und"
SPARE = 4.0


@dataclass(frozen=True)
class Settings:
    """Shape and training of the network; ``max_rows`` and ``per_language`` bound the sample."""

    window: int = 192
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 12
    embedding: int = 8
    max_rows: int = 4000
    per_language: int = 500
    windows: int = 3
    steps: int = 900
    batch: int = 64
    rate: float = 0.01
    seed: int = 42


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for testing: the checksum of its id is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def training_windows(docs: DataFrame, settings: Settings = Settings()) -> pd.DataFrame:
    """The bounded sample: ``lang`` and ``part``, windows at seeded places of labelled texts."""
    labelled = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0)
                          & ~held_out(F.col("doc_id")))
    # At most as many rows as the sample come to the driver and go back: languages by their count.
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), "lang").limit(settings.max_rows).collect()
    known = docs.sparkSession.createDataFrame([tuple(r) for r in counts], "lang string, _n long")
    # Hashes are even over 64 bits, so this bound lets about SPARE times the wanted rows of a language
    # through, however many it has and in however many parts they lie. What goes on is cut to windows
    # before it is shuffled, and equal rows are one.
    bound = F.lit(SPARE * settings.per_language) / F.col("_n") * 2.0 ** 64 - 2.0 ** 63
    few = labelled.select("doc_id", "lang", "text").join(F.broadcast(known), "lang").withColumn(
        "_order", F.xxhash64(F.lit(settings.seed), "doc_id", "text")).where(
        F.col("_order").cast("double") <= bound)
    cuts = few.select("doc_id", "lang", "_order", F.transform(
        F.sequence(F.lit(0), F.lit(settings.windows - 1)),
        lambda i: F.substring(F.col("text"), (F.lit(1) + F.pmod(
            F.xxhash64("doc_id", i), F.greatest(F.length("text") - settings.window // 2,
                                                F.lit(1)))).cast("int"),
            F.lit(settings.window))).alias("_parts")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_order", "doc_id", "_parts"))
    rows = (cuts.withColumn("_rank", rank).where(F.col("_rank") <= settings.per_language)
            .orderBy("_rank", "_order", "doc_id", "_parts").limit(settings.max_rows))
    return rows.select("lang", F.explode("_parts").alias("part")).toPandas()


def cut(text: bytes, window: int, overlap: int) -> np.ndarray:
    """Windows over a whole text, from the first byte to the last; the last is padded with zeros."""
    step = window - overlap
    n = max(1, -(-(len(text) - overlap) // step))
    padded = np.zeros((n - 1) * step + window, dtype=np.uint8)
    padded[:len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, window)[::step]


class ByteNetwork:
    """Embedding, filters of several widths, max pooling, softmax."""

    def __init__(self, languages: Sequence[str], settings: Settings = Settings()) -> None:
        self.languages, self.settings = list(languages), settings
        rng = np.random.default_rng(settings.seed)
        e, f = settings.embedding, settings.filters
        self.weights = {"embedding": rng.normal(0, 0.5, (256, e)).astype("float32"),
                        "out": np.zeros((f * len(settings.widths), len(languages)), "float32"),
                        "out_bias": np.zeros(len(languages), "float32")}
        self.weights["embedding"][0] = 0  # padding
        for w in settings.widths:
            self.weights[f"filter{w}"] = rng.normal(0, (2 / (w * e)) ** 0.5, (w, e, f)
                                                    ).astype("float32")
            self.weights[f"bias{w}"] = np.zeros(f, "float32")
        self._pairs = None

    def _answers(self, windows: np.ndarray, w: int) -> np.ndarray:
        """Answer of each filter of one width at each place."""
        table = np.einsum("be,wef->wbf", self.weights["embedding"], self.weights[f"filter{w}"])
        n = windows.shape[1] - w + 1
        total = table[0][windows[:, :n]]
        for place in range(1, w):
            total += table[place][windows[:, place:place + n]]
        return total

    def train(self, windows: np.ndarray, labels: np.ndarray) -> None:
        """Adam on the cross-entropy; the pooled places alone carry gradients."""
        s, rng = self.settings, np.random.default_rng(self.settings.seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.zeros(0, dtype=int)
        for step in range(1, s.steps + 1):
            if len(order) < min(s.batch, len(windows)):
                order = rng.permutation(len(windows))
            part, order = order[:s.batch], order[s.batch:]
            for name, g in self._gradients(windows[part], labels[part]).items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                self.weights[name] -= s.rate * (first[name] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
            self.weights["embedding"][0] = 0
        self._pairs = None

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        s, n = self.settings, len(windows)
        at, pooled = {}, []
        for w in s.widths:
            answers = self._answers(windows, w)
            at[w] = answers.argmax(axis=1)
            best = np.take_along_axis(answers, at[w][:, None, :], 1)[:, 0, :]
            pooled.append(best + self.weights[f"bias{w}"])
        pooled = np.hstack(pooled)
        active = np.maximum(pooled, 0)
        odds = softmax(active @ self.weights["out"] + self.weights["out_bias"])
        odds[np.arange(n), labels] -= 1
        odds /= n
        out = {"out": active.T @ odds, "out_bias": odds.sum(axis=0),
               "embedding": np.zeros_like(self.weights["embedding"])}
        back = (odds @ self.weights["out"].T) * (pooled > 0)
        for i, w in enumerate(s.widths):
            g = back[:, i * s.filters:(i + 1) * s.filters]
            out[f"bias{w}"] = g.sum(axis=0)
            kernel = np.zeros_like(self.weights[f"filter{w}"])
            for place in range(w):
                seen = windows[np.arange(n)[:, None], at[w] + place]
                kernel[place] = np.einsum("nf,nfe->ef", g, self.weights["embedding"][seen])
                np.add.at(out["embedding"], seen.ravel(), np.einsum(
                    "nf,ef->nfe", g, self.weights[f"filter{w}"][place]).reshape(-1, s.embedding))
            out[f"filter{w}"] = kernel
        return out

    def _pair_tables(self) -> list[tuple[int, int, np.ndarray]]:
        """(width, place, table): neighbouring places of a filter as one table over byte pairs."""
        if self._pairs is None:
            self._pairs = []
            for w in self.settings.widths:
                table = np.einsum("be,wef->wbf", self.weights["embedding"],
                                  self.weights[f"filter{w}"])
                for place in range(0, w - 1, 2):
                    pair = table[place][:, None, :] + table[place + 1][None, :, :]
                    self._pairs.append((w, place, pair.reshape(65536, -1)))
                if w % 2:
                    self._pairs.append((w, w - 1, table[w - 1]))
        return self._pairs

    def log_odds(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of each language for each window."""
        s = self.settings
        tables = self._pair_tables()
        found = np.empty((len(windows), len(self.languages)), "float32")
        for begin in range(0, len(windows), 64):
            part = windows[begin:begin + 64]
            pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
            pooled = []
            for w in s.widths:
                n, total = part.shape[1] - w + 1, None
                for width, place, table in tables:
                    if width == w:
                        keys = pairs if len(table) > 256 else part
                        seen = table.take(keys[:, place:place + n], axis=0)
                        total = seen if total is None else np.add(total, seen, out=total)
                pooled.append(total.max(axis=1) + self.weights[f"bias{w}"])
            active = np.maximum(np.hstack(pooled), 0)
            found[begin:begin + 64] = np.log(softmax(
                active @ self.weights["out"] + self.weights["out_bias"]) + 1e-12)
        return found

    def judge(self, texts: Sequence[bytes]) -> list[tuple[str, float]]:
        """Language and score of each whole text: the mean of its windows' log probabilities."""
        overlap = max(self.settings.widths) - 1
        pieces = [cut(t, self.settings.window, overlap) for t in texts]
        if not pieces:
            return []
        found = self.log_odds(np.concatenate(pieces)).astype("float64")
        out, at = [], 0
        for text, piece in zip(texts, pieces):
            n = len(piece)
            # The last window counts by the bytes it holds.
            weight = np.ones(n)
            weight[-1] = max(len(text) - (n - 1) * (self.settings.window - overlap), 1
                             ) / self.settings.window
            odds = softmax((weight @ found[at:at + n] / weight.sum())[None, :])[0]
            best = int(odds.argmax())
            out.append((self.languages[best], float(odds[best])))
            at += n
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    powers = np.exp(x - x.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def train(docs: DataFrame, settings: Settings = Settings()) -> ByteNetwork | None:
    """A network trained on the bounded sample; nothing if no row is labelled."""
    sample = training_windows(docs, settings)
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    windows = np.concatenate([
        cut(part.encode("utf-8", "replace")[:settings.window], settings.window, 0)[:1]
        for part in sample["part"]])
    labels = np.searchsorted(languages, sample["lang"].to_numpy())
    network = ByteNetwork(languages, settings)
    network.train(windows, labels)
    return network


JUDGED = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def _judge(network: ByteNetwork | None):
    @F.pandas_udf(JUDGED)
    def judge(texts: pd.Series) -> pd.DataFrame:
        rows = [(UNDETERMINED, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts)
                 if network is not None and t and any(map(str.isalpha, t))]
        for begin in range(0, len(known), 64):
            part = known[begin:begin + 64]
            found = network.judge([texts.iloc[i].encode("utf-8", "replace") for i in part])
            for i, answer in zip(part, found):
                rows[i] = answer
        return pd.DataFrame(rows, columns=JUDGED.names)
    return judge


def identified(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """Add ``lang_pred`` and ``score``; the text is all that is looked at."""
    for_python(docs.sparkSession)
    found = docs.withColumn("_found", _judge(network)(F.col("text")))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"),
                              "score": F.col("_found.score")}).drop("_found")


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Train on what is not held out and judge every document."""
    docs = docs.select("doc_id", "text", "lang")
    judged = identified(docs.select("doc_id", "text"), train(docs, settings))
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
