"""Secret scans: patterns with fixed shapes, and credential values that are hard to guess.

The base patterns find assignments, access keys and long hexadecimal runs. The method looks at every
value that stands in a credential context (after ``password is``, ``pwd=``, ``Bearer``, in a URL's
``user:value@host``) and computes the least number of guesses that reach it: the cheapest
segmentation of the value into dictionary words, dates, repeats, keyboard walks and brute-force
spans, found by dynamic programming over its positions. A value that costs at least
``min_log10_guesses`` is a secret; ``changeme`` or ``2024-01-01`` is not.

The dictionary has the hundred ``WORDS`` that guessers try first and after them the 37,659 entries of
``words.txt`` by rank (common English words; its head says where they come from), so that prose such
as ``the password is incorrect`` holds no secret. A word that it lacks is put together from its
entries and single letters, which is dearer; a long word without known parts still counts as a
secret, which concerns other languages above all, as the list is English.

The dynamic programme goes from the end of the value to its start. Repeats and walks run to their end:
a counter for each unit size says how far the value goes on repeating itself, and brute-force spans
are made of single characters, so the work is linear in the value's length and whole values of any
length are judged. A unit of n characters costs at least n, so units longer than the wanted least
cannot change a verdict and are not looked at. One row at a time is held.

Defined cases: a null text is empty; an empty text has no spans; repeated rows and null ids are
scanned like any other row; other columns are passed by ``redact`` untouched and not read by
``scan``.
"""

from __future__ import annotations

import hashlib
import math
import pkgutil
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tripmill.llm.common import for_python

# --- fixed values: base patterns, in the order that decides ties -----------------------------------
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
MIN_ASSIGNED = 6

# --- fixed values: credential contexts of the method (group 1 is the value) -------------------------
CONTEXTS = (
    re.compile(r"""(?i:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|credential)s?["']?"""
               r"""[\x20\t]*(?::=|=>|[:=]|(?i:\bis\b))[\x20\t]*["'`]?([^\s"'`,;<>(){}]+)""", re.ASCII),
    re.compile(r"(?i:\bbearer|\bbasic)\x20+([A-Za-z0-9+/_.~=-]{12,})", re.ASCII),
    re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]*:([^\s/@]+)@", re.ASCII),
)

# --- fixed values: guessing tables ------------------------------------------------------------------
#: Words that guessers try first, the commonest first; those of ``words.txt`` come after them.
WORDS = (
    "password", "letmein", "welcome", "monkey", "dragon", "master", "login", "admin", "qwerty",
    "iloveyou", "princess", "sunshine", "football", "baseball", "shadow", "superman", "batman",
    "trustno", "hello", "freedom", "whatever", "charlie", "secret", "changeme", "default", "guest",
    "root", "user", "test", "testing", "example", "sample", "demo", "temp", "access", "pass", "token",
    "key", "none", "null", "true", "false", "your", "here", "insert", "placeholder", "redacted",
    "hidden", "the", "and", "you", "love", "summer", "winter", "spring", "autumn", "january",
    "february", "march", "april", "june", "july", "august", "september", "october", "november",
    "december", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday",
    "michael", "jordan", "daniel", "thomas", "robert", "andrew", "jessica", "ashley", "michelle",
    "orange", "banana", "cookie", "computer", "internet", "server", "database", "system", "service",
    "company", "public", "private", "string", "value", "config", "setting", "environment",
)
#: Keyboard rows and columns along which fingers walk.
WALKS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./", "1qaz", "2wsx", "3edc",
         "4rfv", "5tgb", "6yhn", "7ujm", "8ik,", "9ol.", "0p;/", "abcdefghijklmnopqrstuvwxyz")
SWAPS = str.maketrans("4@831!05$7+2", "aabeiiossttz")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")

# --- parameters -------------------------------------------------------------------------------------
MIN_LOG10_GUESSES = 10.0
MIN_VALUE = 6

_LISTED = [w for w in pkgutil.get_data("tripmill.llm", "words.txt").decode("ascii").splitlines()
           if not w.startswith("#")]
_RANK = {w: i + 1 for i, w in enumerate(dict.fromkeys([*WORDS, *_LISTED]))}
_LONGEST = max(map(len, _RANK))
_NEXT = {(a, b) for walk in WALKS for line in (walk, walk[::-1]) for a, b in zip(line, line[1:])}
#: log10 of the guesses of one character by its alphabet, and of beginning another segment.
_ALPHABETS = ((str.isdigit, 1.0), (str.islower, 1.415), (str.isupper, 1.415))
_OTHER = 1.52
_JOIN = 0.3


def _character(c: str) -> float:
    for of, cost in _ALPHABETS:
        if of(c):
            return cost
    return _OTHER


def _stretches(value: str, longest_unit: int) -> Iterator[tuple[int, int, list[int]]]:
    """From the last position to the first: the position, the end of the walk that begins there, and
    for each unit size how many characters from there on equal the one that much later. The list is
    the same one each time."""
    walk, same = len(value), [0] * (longest_unit + 1)
    for start in range(len(value) - 1, -1, -1):
        if start + 1 < len(value) and (value[start].lower(), value[start + 1].lower()) not in _NEXT:
            walk = start + 1
        for size in range(1, min(longest_unit, len(value) - 1 - start) + 1):
            same[size] = same[size] + 1 if value[start] == value[start + size] else 0
        yield start, walk, same


def _segments(value: str, start: int, walk: int | None = None,
              same: list[int] | None = None) -> Iterator[tuple[int, float]]:
    """Ends and log10 guesses of the cheap segments that begin at a position; ``walk`` and ``same`` are
    what ``_stretches`` says of it."""
    if same is None:
        for at, walk, same in _stretches(value, len(value) // 2):
            if at == start:
                break
    for size in range(3, min(_LONGEST, len(value) - start) + 1):
        part = value[start:start + size]
        lower = part.lower()
        plain = lower if lower in _RANK else lower.translate(SWAPS)
        if plain in _RANK:
            cased = 0.0 if part == lower else 0.3 if part in (lower.title(), lower.upper()) else 1.0
            swapped = 0.0 if plain == lower else 0.7
            yield start + size, math.log10(_RANK[plain] + 1) + cased + swapped
    for found in {m.end() for m in [DATE.match(value, start), DATE.match(value, start, start + 4)]
                  if m}:
        yield found, 2.1 if found - start == 4 else 4.6
    if walk - start >= 3:
        yield walk, 1.7 + math.log10(walk - start)
    for size in range(1, len(same)):
        # A single character counts as a repeat from three times on.
        if same[size] >= max(size, 2):
            times = same[size] // size + 1
            unit = value[start:start + size]
            yield start + size * times, sum(map(_character, unit)) + math.log10(times)


@lru_cache(maxsize=20_000)
def log10_guesses(value: str, enough: float = MIN_LOG10_GUESSES) -> float:
    """Least log10 guesses over all segmentations of a value; 0 for an empty one. Exact below
    ``enough``; otherwise at least that, without regard to repeats of longer units."""
    best = [math.inf] * len(value) + [0.0]
    longest_unit = min(len(value) // 2, max(2, math.ceil(enough)))
    for start, walk, same in _stretches(value, longest_unit):
        # A brute-force span grows one character at a time, so any span is covered.
        least = _character(value[start]) + best[start + 1]
        for end, cost in _segments(value, start, walk, same):
            least = min(least, cost + _JOIN + best[end])
        best[start] = least
    return best[0]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the base patterns in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if len(m.group(2)) >= MIN_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guessed_spans(text: str, min_log10_guesses: float) -> set[tuple[int, int, int]]:
    """Values in credential contexts that cost at least so many guesses."""
    found = set()
    for context in CONTEXTS:
        for m in context.finditer(text):
            value = m.group(1).rstrip(".!?")
            if len(value) >= MIN_VALUE and log10_guesses(value, min_log10_guesses) >= min_log10_guesses:
                found.add((m.start(1), 3, m.start(1) + len(value)))
    return found


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


SPANS = StructType([
    StructField("n_assign", LongType()), StructField("n_access", LongType()),
    StructField("n_hex", LongType()), StructField("base_spans", StringType()),
    StructField("spans", StringType()),
])


def _scanner(min_log10_guesses: float):
    @F.pandas_udf(SPANS)
    def scan_texts(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            text = text or ""
            base = base_spans(text)
            every = sorted({*base, *guessed_spans(text, min_log10_guesses)})
            counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
            rows.append((*counts, _joined(base), _joined(every)))
        return pd.DataFrame(rows, columns=SPANS.names)
    return scan_texts


def spans(text: Column, min_log10_guesses: float = MIN_LOG10_GUESSES) -> Column:
    """Counts of the base patterns, their spans and all spans, as ``kind:start:end`` in order."""
    return _scanner(min_log10_guesses)(text)


def scan(docs: DataFrame, min_log10_guesses: float = MIN_LOG10_GUESSES) -> DataFrame:
    """Per document the counts and spans of its secrets."""
    for_python(docs.sparkSession)
    found = docs.select("doc_id", spans(F.col("text"), min_log10_guesses).alias("found"))
    return found.select("doc_id", "found.*")


def digest(scanned: DataFrame) -> DataFrame:
    """The scan with the base spans as a hash."""
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex",
                          F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


def _redactor(mark: str, min_log10_guesses: float):
    @F.pandas_udf(StringType())
    def redact_texts(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            if not text:
                out.append(text)
                continue
            kept, at = [], 0
            for start, _, end in sorted({*base_spans(text),
                                         *guessed_spans(text, min_log10_guesses)}):
                if end > at:
                    kept.append(text[at:start])
                    if start >= at:
                        kept.append(mark)
                    at = end
            out.append("".join(kept) + text[at:] if at else text)
        return pd.Series(out, dtype=object)
    return redact_texts


def redact(docs: DataFrame, mark: str = "[secret]",
           min_log10_guesses: float = MIN_LOG10_GUESSES) -> DataFrame:
    """The documents with every span replaced by ``mark``; other columns stay as they are."""
    for_python(docs.sparkSession)
    return docs.withColumn("text", _redactor(mark, min_log10_guesses)(F.col("text")))


def sha256_of(joined: str) -> str:
    """What ``digest`` makes of joined spans, for checks outside Spark."""
    return hashlib.sha256(joined.encode()).hexdigest()
