"""SentencePiece encoding and decoding with byte spans, for BPE models.

A text is normalised by the model's compiled character map: at each place the longest source prefix
that the map knows is replaced, anything else is taken over, and every normalised character records
the byte of the source where it came from. Pieces are merged in order of their scores, unknown
characters fall back to bytes, and each piece is projected through that record to the span of source
bytes it stands for.

If no piece of the model has a space mark after another character, merges never cross the beginning
of a word, so words are encoded one by one and each worker remembers the ids of the words it has met
lately (two generations of at most ``REMEMBERED``); new words of many texts are merged together. For
other models the whole text is one word. Texts are encoded whole where they lie, without a shuffle; the
model is a file parameter, read by the driver once and sent along (half a MB).

Defined cases: a null or empty text has no ids and decodes to an empty text; repeated rows and null
ids are encoded like any other; other columns are kept by ``with_pieces``; a null id array decodes to
an empty text.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, LongType, StringType, StructField, StructType,
)

from tripmill.llm.common import for_python

# --- fixed values: the model format -----------------------------------------------------------------
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
REPLACED = "�"
UNKNOWN_SURFACE = " ⁇ "

# --- parameters -------------------------------------------------------------------------------------
REMEMBERED = 120_000  # words of each of two generations
LONG_WORD = 40        # characters beyond which a word is merged by a heap and not remembered
BATCH = 64

NO_PIECE = float("-inf")


def fields(message: bytes):
    """Numbers and values of a protocol-buffer message; varints as int, the rest as bytes."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = message[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(message):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, message[at:at + size]
            at += size


class CharacterMap:
    """The compiled character map: a double-array trie over source prefixes, and replacements."""

    def __init__(self, compiled: bytes) -> None:
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = compiled[4 + size:]

    def longest(self, source: bytes, at: int) -> tuple[int, str] | None:
        """Length and replacement of the longest known prefix of the source from a place on."""
        units = self.units
        if not units:
            return None
        found = None
        node = units[0]
        place = (node >> 10) << ((node & 512) >> 6)
        for end in range(at, len(source)):
            label = source[end]
            place ^= label
            node = units[place]
            if node & 0x800000FF != label:
                break
            place ^= (node >> 10) << ((node & 512) >> 6)
            if node & 256:
                found = end + 1 - at, units[place] & 0x7FFFFFFF
        if found is None:
            return None
        stop = self.replacements.index(b"\0", found[1])
        return found[0], self.replacements[found[1]:stop].decode("utf-8", "replace")


class PieceModel:
    """Vocabulary and normalisation of a model file of kind BPE."""

    def __init__(self, serialized: bytes) -> None:
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normalizer = {}, {}
        for number, value in fields(serialized):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normalizer = dict(fields(value))
        if trainer.get(3, 1) != BPE:
            raise ValueError("only models of kind BPE are supported")
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix = bool(trainer.get(24, 0))
        self.map = CharacterMap(normalizer.get(2, b""))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        self.squeeze = bool(normalizer.get(4, 1))
        self.escape = bool(normalizer.get(5, 1))
        usable = (NORMAL, USER, UNUSED)
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in usable}
        if any(k in (USER, UNUSED) for k in self.kinds) or self.suffix:
            raise ValueError("user-defined and unused pieces and space suffixes are not supported")
        self.score_of = {p: self.scores[i] for p, i in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.special = {i for i, k in enumerate(self.kinds) if k in (UNKNOWN, CONTROL, BYTE)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces)
                      if self.kinds[i] == BYTE}
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.word = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if self.by_words else "(?s:.+)")
        #: Ids of the words met lately, and of those met before them.
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        #: Of each id the characters it stands for (bytes count 1), whether it is a byte that goes on
        #: with a character, its text in decimals, and the bytes it decodes to.
        self.lengths = np.array([1 if i in self.special else len(p)
                                 for i, p in enumerate(self.pieces)], np.int32)
        self.goes_on = np.zeros(len(self.pieces), bool)
        self.goes_on[[i for b, i in self.bytes.items() if 0x80 <= b < 0xC0]] = True
        self.decimals = [str(i) for i in range(len(self.pieces))]
        self.raw = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
                    else UNKNOWN_SURFACE.encode() if k == UNKNOWN else p.encode()
                    for p, k in zip(self.pieces, self.kinds)]
        self.merger: Merger | None = None

    # -- normalisation --------------------------------------------------------------------------------

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its characters and its end the byte of the source."""
        if not self.map.units and not self.squeeze:
            return self._taken_over(text)
        source = text.encode("utf-8", "replace")
        out, origin, at = [], [], 0
        space = SPACE if self.escape else " "

        def step(at: int) -> tuple[int, str]:
            known = self.map.longest(source, at)
            if known:
                return known
            first = source[at]
            size = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
            return size, source[at:at + size].decode("utf-8", "replace")

        if self.squeeze:
            while at < len(source) and step(at)[1] == " ":
                at += step(at)[0]
        if at == len(source):
            return "", np.zeros(1, np.int32)
        if self.dummy_prefix:
            out.append(space)
            origin.append(at)
        after_space = self.squeeze
        while at < len(source):
            size, part = step(at)
            if after_space:
                part = part.lstrip(" ")
            out += part.replace(" ", space)
            origin += [at] * len(part)
            if part:
                after_space = self.squeeze and part.endswith(" ")
            at += size
        if self.squeeze:
            while out and out[-1] == space:
                out.pop()
                at = origin.pop()
        return "".join(out), np.array([*origin, at], np.int32)

    def _taken_over(self, text: str) -> tuple[str, np.ndarray]:
        """Without a map every character is taken over, so the record is a running sum of widths."""
        if not text:
            return "", np.zeros(1, np.int32)
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        widths = 1 + (codes > 0x7F).astype(np.int32) + (codes > 0x7FF) + (codes > 0xFFFF)
        prefix = int(self.dummy_prefix)
        origin = np.zeros(len(codes) + 1 + prefix, np.int32)
        np.cumsum(widths, out=origin[1 + prefix:])
        plain = text.replace(" ", SPACE) if self.escape else text
        return (SPACE if self.escape else " ") * prefix + plain, origin

    # -- merging --------------------------------------------------------------------------------------

    def _merged(self, word: str) -> list[str]:
        """Merge the characters of a word, the best score first, the leftmost of equals."""
        return self._merged_short(word) if len(word) <= LONG_WORD else self._merged_long(word)

    def _merged_short(self, word: str) -> list[str]:
        score, parts = self.score_of.get, list(word)
        scores = [score(a + b, NO_PIECE) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == NO_PIECE:
                break
            i = scores.index(best)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NO_PIECE)
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NO_PIECE)
        return parts

    def _merged_long(self, word: str) -> list[str]:
        """The same with a heap, for words without end."""
        score_of = self.score_of
        parts: list[str | None] = list(word)
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[float, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b < n:
                s = score_of.get(parts[a] + parts[b])
                if s is not None:
                    heapq.heappush(heap, (-s, a, len(parts[a]), len(parts[b])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, size_a, size_b = heapq.heappop(heap)
            b = after[a]
            if parts[a] is None or len(parts[a]) != size_a or b >= n or len(parts[b]) != size_b:
                continue
            parts[a] += parts[b]
            parts[b] = None
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [p for p in parts if p is not None]

    def _encoded(self, word: str) -> list[int]:
        """Ids of a word."""
        ids = []
        for part in self._merged(word):
            place = self.ids.get(part)
            if place is not None:
                ids.append(place)
            elif self.byte_fallback and self.bytes:
                ids += [self.bytes[b] for b in part.encode("utf-8", "replace")]
            else:
                ids.append(self.unknown)
        return ids

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered; short ones are remembered from now on."""
        found, new = {}, []
        for word in words:
            known = self.older.get(word)
            if known is None:
                new.append(word)
            else:
                found[word] = known
        if self.by_words:
            if self.merger is None:
                self.merger = Merger(self.ids, self.score_of)
            short = [w for w in new if len(w) <= LONG_WORD]
            found.update(zip(short, self.merger.merge(short)))
            new = [w for w in new if len(w) > LONG_WORD] + [w for w in short if found[w] is None]
        for word in new:
            found[word] = array("i", self._encoded(word)).tobytes()
        if len(self.remembered) + len(found) > REMEMBERED:
            self.older, self.remembered = self.remembered, {}
        self.remembered.update((w, k) for w, k in found.items() if len(w) <= LONG_WORD)
        return found

    def encode_all(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text its ids and the first and past-the-last source byte of each; the words of all
        texts that are not known yet are merged together."""
        split = []
        for text in texts:
            plain, origin = self.normalise(text)
            split.append((self.word.findall(plain), origin))
        words = set().union(*[w for w, _ in split])
        known = {w: k for w in words if (k := self.remembered.get(w)) is not None}
        known.update(self._learn(words - known.keys()))
        out = []
        for words, origin in split:
            ids = np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32)
            out.append((ids, *self._spans(ids, origin)))
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and the first and past-the-last source byte of each."""
        return self.encode_all([text])[0]

    def _spans(self, ids: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The source bytes that each id stands for, by the record of the normalised characters."""
        taken = self.lengths[ids]
        # Bytes of one character count -1 but the last.
        taken[np.flatnonzero(self.goes_on[ids[1:]])] = -1
        ends = np.cumsum(np.maximum(taken, 0))
        starts = ends - np.maximum(taken, 0)
        first, last = origin[starts], origin[ends]
        begun = np.flatnonzero(taken < 0)
        if len(begun):
            # Bytes before the last of a character: its span if the source has other bytes there,
            # else the byte itself.
            first[begun], last[begun] = origin[starts[begun]], origin[starts[begun] + 1]
            self._split_bytes(taken, first, last)
        return first.astype(np.int32), last.astype(np.int32)

    def line(self, ids: Sequence[int]) -> str:
        """Ids in decimals, joined by commas."""
        return ",".join(map(self.decimals.__getitem__, ids))

    @staticmethod
    def _split_bytes(taken: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        run = 0
        for i in np.flatnonzero((taken < 0) | np.concatenate([[False], taken[:-1] < 0])
                                if len(taken) else []):
            run += 1
            if taken[i] > 0:
                if last[i] - first[i] == run:
                    begin = first[i]
                    for k in range(run):
                        first[i - run + 1 + k], last[i - run + 1 + k] = begin + k, begin + k + 1
                run = 0

    # -- decoding -------------------------------------------------------------------------------------

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: bytes are joined to characters, the space put before the text is dropped."""
        pieces, kinds = self.pieces, self.kinds
        if not self.squeeze and len(ids) and ids[0] not in self.special:
            try:
                text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8")
                return text[self.dummy_prefix and text[:1] == SPACE:].replace(SPACE, " ")
            except UnicodeDecodeError:  # bytes that are no characters
                pass
        out, raw = [], bytearray()
        at_start = self.dummy_prefix or self.squeeze
        for i in ids:
            kind = kinds[i]
            if kind == BYTE:
                raw.append(int(pieces[i][3:5], 16))
                at_start = False
                continue
            if raw:
                out.append(characters(bytes(raw)))
                raw.clear()
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(UNKNOWN_SURFACE)
                at_start = False
                continue
            piece = pieces[i]
            if at_start:
                if piece.startswith(SPACE):
                    piece = piece[1:]
                    at_start = self.squeeze and not piece
                else:
                    at_start = False
            out.append(piece)
        if raw:
            out.append(characters(bytes(raw)))
        return "".join(out).replace(SPACE, " ")


class Merger:
    """Merges many words at once: a row of symbols per word, one merge of every row per step.

    Symbols are the pieces and their characters. The two that join to a piece are looked up in an open
    hash table of their numbers, which holds the piece and the place of its score.
    """

    NONE = np.int32(2 ** 31 - 1)

    def __init__(self, ids: dict[str, int], scores: dict[str, float]) -> None:
        symbols = sorted({c for p in ids for c in p} | set(ids))
        number = {t: i for i, t in enumerate(symbols)}
        self.ids = np.array([ids.get(t, -1) for t in symbols] + [-1], np.int32)
        self.of_code = np.full(0x110000, len(symbols), np.int32)
        for t, i in number.items():
            if len(t) == 1:
                self.of_code[ord(t)] = i
        order = {x: i for i, x in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs, values = [], []
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    values.append((order[score], number[piece]))
        keys = np.array(pairs, np.int64)
        values = np.array(values, np.int32).reshape(-1, 2)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, self.NONE, np.int32)
        self.joined = np.zeros(size, np.int32)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slots[left]] < 0
            _, first = np.unique(slots[left], return_index=True)
            first = first[free[first]]
            placed = left[first]
            self.keys[slots[placed]] = keys[placed]
            self.ranks[slots[placed]], self.joined[slots[placed]] = values[placed].T
            left = np.delete(left, first)
            slots[left] = (slots[left] + 1) % size

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the score and number of the piece that symbols join to."""
        keys = a.astype(np.int64) << 32 | b
        slots = self._slots(keys)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            there = self.keys[slots[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return np.where(self.keys[slots] == keys, self.ranks[slots], self.NONE), self.joined[slots]

    def merge(self, words: list[str]) -> list[bytes | None]:
        """Packed ids of the pieces of each word; nothing for words with characters that are none."""
        out: list[bytes | None] = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        for begin in range(0, len(order), 4096):
            rows = order[begin:begin + 4096]
            self._merge([words[i] for i in rows], rows, lengths[rows], out)
        return out

    def _merge(self, words: list[str], rows: np.ndarray, lengths: np.ndarray,
               out: list[bytes | None]) -> None:
        width = int(lengths[-1])
        if width == 0:
            return
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        parts = np.full((len(words), width), -1, np.int32)
        parts[np.arange(width) < lengths[:, None]] = self.of_code[codes]
        ranks, joined = (x.reshape(len(words), width - 1) for x in self._find(
            parts[:, :-1].ravel(), parts[:, 1:].ravel()))
        ranks = np.where(np.arange(1, width) < lengths[:, None], ranks, self.NONE)
        while True:
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                more = ranks[np.arange(len(rows)), at] < self.NONE
            else:
                more = np.zeros(len(rows), bool)
            done = np.flatnonzero(~more)
            if len(done):
                self._tell(rows[done], self.ids[parts[done]], lengths[done], out)
            if not more.any():
                return
            keep = np.flatnonzero(more)
            rows, lengths, at = rows[keep], lengths[keep] - 1, at[keep]
            parts, ranks, joined = parts[keep], ranks[keep], joined[keep]
            every = np.arange(len(rows))
            here = joined[every, at]
            parts[every, at] = here
            wide = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, wide + (wide > at[:, None]), axis=1)
            narrow = np.arange(ranks.shape[1] - 1)
            moved = narrow + (narrow >= at[:, None])
            ranks = np.take_along_axis(ranks, moved, axis=1)
            joined = np.take_along_axis(joined, moved, axis=1)
            for side, some in ((at - 1, at > 0), (at, at < lengths - 1)):
                row, column = every[some], side[some]
                ranks[row, column], joined[row, column] = self._find(
                    parts[row, column], parts[row, column + 1])

    @staticmethod
    def _tell(rows: np.ndarray, ids: np.ndarray, lengths: np.ndarray,
              out: list[bytes | None]) -> None:
        strange = ((ids < 0) & (np.arange(ids.shape[1]) < lengths[:, None])).any(axis=1)
        packed, stride = np.ascontiguousarray(ids, np.int32).tobytes(), 4 * ids.shape[1]
        ends = np.arange(len(rows)) * stride
        for row, begin, end, no in zip(rows.tolist(), ends.tolist(), (ends + 4 * lengths).tolist(),
                                       strange.tolist()):
            out[row] = None if no else packed[begin:end]


def characters(raw: bytes) -> str:
    """Bytes as characters; each byte that begins none is one replacement character."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at:at + size].decode("utf-8"))
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append(REPLACED)
                at += 1
        return "".join(out)


_loaded: dict[int, PieceModel] = {}


def _model(serialized: bytes) -> PieceModel:
    """The model of this worker, which keeps the words it remembers from task to task."""
    key = hash(serialized)
    if key not in _loaded:
        _loaded[key] = PieceModel(serialized)
    return _loaded[key]


ENCODED = StructType([StructField(c, ArrayType(IntegerType())) for c in ("ids", "starts", "ends")])


def _encoder(serialized: bytes):
    @F.pandas_udf(ENCODED)
    def encode_texts(texts: pd.Series) -> pd.DataFrame:
        rows = [r for part in _batches(texts) for r in _model(serialized).encode_all(part)]
        return pd.DataFrame({name: pd.Series([r[i] for r in rows], dtype=object)
                             for i, name in enumerate(ENCODED.names)})
    return encode_texts


def _batches(texts: pd.Series):
    for begin in range(0, len(texts), BATCH):
        yield [t or "" for t in texts.iloc[begin:begin + BATCH]]


def _decoder(serialized: bytes):
    @F.pandas_udf(StringType())
    def decode_ids(column: pd.Series) -> pd.Series:
        model = _model(serialized)
        return pd.Series(["" if ids is None else model.decode(ids.tolist()) for ids in column],
                         dtype=object)
    return decode_ids


def read_model(path: str) -> bytes:
    with open(path, "rb") as source:
        return source.read()


def with_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """Add ``ids``, ``starts`` and ``ends`` of every whole text; ends are past the last byte."""
    for_python(docs.sparkSession)
    found = docs.withColumn("_found", _encoder(read_model(model_path))(F.col("text")))
    return found.withColumns({c: F.col(f"_found.{c}") for c in ENCODED.names}).drop("_found")


def with_decoded(encoded: DataFrame, model_path: str) -> DataFrame:
    """Add ``decoded``, the text of ``ids``."""
    for_python(encoded.sparkSession)
    return encoded.withColumn("decoded", _decoder(read_model(model_path))(F.col("ids")))


TOLD = StructType([
    StructField("ids", ArrayType(IntegerType())), StructField("n_tokens", LongType()),
    StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType()),
    StructField("covered_bytes", LongType())])


def _teller(serialized: bytes, with_ids: bool):
    kind = TOLD if with_ids else StructType(TOLD.fields[1:])

    @F.pandas_udf(kind)
    def tell(texts: pd.Series) -> pd.DataFrame:
        model = _model(serialized)
        rows = []
        for part in _batches(texts):
            for ids, starts, ends in model.encode_all(part):
                listed = ids.tolist()
                back = model.decode(listed)
                rows.append((ids if with_ids else None, len(ids), _sha256(model.line(listed)),
                             _sha256(back), covered(starts, ends)))
        return pd.DataFrame(rows, columns=TOLD.names)[kind.names]
    return tell


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()


def covered(starts: np.ndarray, ends: np.ndarray) -> int:
    """Source bytes within the spans, each counted once."""
    if not len(ends):
        return 0
    before = np.concatenate([[0], np.maximum.accumulate(ends)[:-1]])
    return int(np.maximum(ends - np.maximum(starts, before), 0).sum())


def told(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """The documents with a struct ``_told``: the number of ids of the whole text, hashes of ids and of
    the text they decode to, the bytes of the source within their spans, and the ids if wanted.

    One pass encodes each text into ids and spans and decodes the ids.
    """
    for_python(docs.sparkSession)
    return docs.withColumn("_told", _teller(read_model(model_path), with_ids)(F.col("text")))


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the number of its ids, hashes of ids and of the text they decode to, and how many
    bytes of the source the ids cover."""
    return told(docs.select("doc_id", "text"), model_path).select("doc_id", "_told.*")
