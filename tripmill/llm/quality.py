"""Quality rules: distribution divergence from language references, beside word-level rules.

Character classes and common words of every whole text are counted, compared with the reference
histogram of the row's declared language by Jensen-Shannon distance (in bits); without a reference
for that language the nearest one decides. A text below a minimum length gives too few counts for that comparison and is judged by the base
rules alone. Everything is a projection of the scanned rows: no shuffle, no Python.

Defined cases: a null or empty text has no words, all counts 0, fails the base rules and is not
kept; repeated rows and null ids are judged like any other row; other columns of the input are not
read. The longest text is held by one row as Spark holds it anyway; its windows take 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import WORD

# --- fixed values: the base rules -----------------------------------------------------------------
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

# --- fixed values: character classes (SYMBOLS are one more; what is in none is a letter or rare) ---
CLASSES = {"upper": "[A-ZÀ-ÖØ-Þ]", "digit": "[0-9]", "point": "[.,;:!?'\"()-]"}
#: Shares of space, upper, digit, point, symbol and the rest in edited prose, by language.
CLASS_SHARES = {
    "en": (0.165, 0.025, 0.005, 0.028, 0.001, 0.776),
    "fr": (0.165, 0.022, 0.005, 0.030, 0.001, 0.777),
    "de": (0.150, 0.040, 0.005, 0.028, 0.001, 0.776),
    "es": (0.165, 0.022, 0.005, 0.028, 0.001, 0.779),
}
#: Shares of the commonest words in running text, by language; the rest is one further bin.
WORD_SHARES = {
    "en": {"the": 0.055, "of": 0.028, "and": 0.025, "to": 0.022, "a": 0.019, "in": 0.017,
           "is": 0.010, "that": 0.010, "it": 0.008, "for": 0.008, "was": 0.007, "on": 0.007,
           "with": 0.006, "as": 0.006, "be": 0.005, "by": 0.005},
    "fr": {"de": 0.050, "la": 0.029, "le": 0.022, "et": 0.020, "les": 0.019, "des": 0.016,
           "en": 0.013, "un": 0.010, "du": 0.010, "une": 0.009, "que": 0.008, "est": 0.008,
           "pour": 0.007, "par": 0.005, "dans": 0.006, "qui": 0.007},
    "de": {"der": 0.035, "die": 0.034, "und": 0.028, "in": 0.019, "den": 0.012, "von": 0.010,
           "zu": 0.010, "das": 0.010, "sich": 0.007, "mit": 0.008, "auf": 0.006, "für": 0.006,
           "des": 0.008, "ist": 0.008, "im": 0.008, "nicht": 0.006},
    "es": {"de": 0.062, "la": 0.037, "que": 0.028, "el": 0.027, "en": 0.025, "y": 0.024,
           "los": 0.016, "se": 0.010, "las": 0.010, "del": 0.011, "un": 0.010, "por": 0.009,
           "con": 0.008, "no": 0.008, "una": 0.007, "para": 0.006},
}

# --- parameters -----------------------------------------------------------------------------------
MAX_CLASS_DISTANCE = 0.18     # Jensen-Shannon distance, the root of the divergence in bits
MAX_WORD_DISTANCE = 0.33
MIN_COMPARED_CHARACTERS = 400
MIN_COMPARED_WORDS = 80

_POSITION_BITS = 24


def divergence(counts: Column, shares: Sequence[float], total: Column) -> Column:
    """Jensen-Shannon divergence in bits between an array of counts over their total and reference
    shares in the same order."""
    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def both(count: Column, q: Column) -> Column:
        p = count / total
        m = (p + q) / F.lit(2.0)
        return term(p, m) + term(q, m)

    parts = F.zip_with(counts, F.array(*[F.lit(float(q)) for q in shares]), both)
    added = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.greatest(added / F.lit(2.0), F.lit(0.0))


def repeated_window_words(words: str, exact: bool = False) -> str:
    """SQL for the number of words inside windows that a text holds twice or more.

    The quick form sorts one long for each window, the top bits of its hash over its position, in
    the column ``_windows``; the exact form sorts the windows themselves, for texts in which two
    different windows share those bits or which have more positions than fit.
    """
    if exact:
        spots = f"""transform(array(array_sort(transform(sequence(0, size({words}) - {WINDOW}),
            i -> struct(slice({words}, i + 1, {WINDOW}) AS k, i AS p)))), s ->
            CASE WHEN size(s) < 2 THEN array() ELSE array_sort(array_distinct(flatten(transform(
              filter(sequence(1, size(s) - 1), j -> s[j].k = s[j - 1].k),
              j -> array(s[j].p, s[j - 1].p))))) END)[0]"""
    else:
        spots = f"""array_sort(array_distinct(flatten(transform(_same,
            j -> array(_windows[j] & {2 ** _POSITION_BITS - 1},
                       _windows[j - 1] & {2 ** _POSITION_BITS - 1})))))"""
    return f"""transform(array({spots}), r -> CASE WHEN size(r) = 0 THEN 0L ELSE
        CAST(aggregate(sequence(0, size(r) - 1), 0L, (a, k) -> a + CASE WHEN k = size(r) - 1
          THEN {WINDOW} ELSE least({WINDOW}, r[k + 1] - r[k]) END) AS BIGINT) END)[0]"""


def measured(docs: DataFrame) -> DataFrame:
    """Add the base counts of every whole text; ``_words`` stays for the common words."""
    df = docs.withColumn("text", F.coalesce("text", F.lit("")))
    # Whatever is counted in the text itself comes first, so that later steps need not carry it.
    df = df.select(
        "doc_id", "lang", F.length("text").alias("_length"),
        F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "").alias("_words"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.array(*[F.regexp_count("text", F.lit(c)) for c in CLASSES.values()]).alias("_counted"),
        F.expr(r"""transform(array(filter(split(text, '\n', -1),
            l -> l RLIKE '[^\\x20\\x09-\\x0D]')), k -> size(k) - size(array_distinct(k)))[0]"""
               ).cast("long").alias("n_dup_lines"))
    top = f"~{2 ** _POSITION_BITS - 1}L"
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "_windows": F.expr(f"""
          CASE WHEN size(_words) < {WINDOW} OR size(_words) > {2 ** _POSITION_BITS} THEN array(0L)
          ELSE sort_array(transform(sequence(0L, size(_words) - {WINDOW}L), i ->
            (xxhash64(_words[i], _words[i + 1], _words[i + 2]) & {top}) | i)) END""")})
    df = df.withColumn("_same", F.expr(f"""
        CASE WHEN size(_windows) < 2 THEN array() ELSE filter(sequence(1, size(_windows) - 1),
            j -> ((_windows[j] ^ _windows[j - 1]) & {top}) = 0) END"""))
    pairs = f"""exists(_same, j -> slice(_words,
                CAST((_windows[j] & {2 ** _POSITION_BITS - 1}) AS INT) + 1, {WINDOW})
             != slice(_words,
                CAST((_windows[j - 1] & {2 ** _POSITION_BITS - 1}) AS INT) + 1, {WINDOW}))"""
    return df.withColumn("n_repeat_words", F.expr(f"""CASE WHEN n_words < {WINDOW} THEN 0L
            WHEN n_words > {2 ** _POSITION_BITS} OR {pairs}
            THEN {repeated_window_words('_words', exact=True)}
            ELSE {repeated_window_words('_words')} END""")).drop("_windows", "_same")


def with_distances(df: DataFrame, class_shares: Mapping[str, Sequence[float]] = CLASS_SHARES,
                   word_shares: Mapping[str, Mapping[str, float]] = WORD_SHARES) -> DataFrame:
    """Add the distances to the reference of the declared language, by classes and by common words;
    where there is no such reference, to the nearest one."""
    common = sorted({w for shares in word_shares.values() for w in shares})
    space = F.col("_length") - F.col("word_chars")
    marked = F.aggregate("_counted", F.col("n_symbols").cast("int"), lambda a, x: a + x)
    df = df.withColumns({
        "_common": F.filter("_words", lambda w: w.isin(common)),
        "_classes": F.concat(F.array(space), F.col("_counted").cast("array<bigint>"),
                             F.array("n_symbols"), F.array(F.col("word_chars") - marked)),
    }).drop("_words")
    by_class = {language: divergence(F.col("_classes"), shares, F.col("_length").cast("double"))
                for language, shares in class_shares.items()}

    def count(word: Column) -> Column:
        return F.size("_common") - F.size(F.array_remove("_common", word))

    def of_words(shares: Mapping[str, float]) -> Column:
        counts = F.transform(F.array(*[F.lit(w) for w in shares]), count)
        known = F.array(F.lit(0)) if not shares else counts
        other = F.transform(F.array(known), lambda c: F.concat(c, F.array(
            F.col("n_words").cast("int") - F.aggregate(c, F.lit(0), lambda a, x: a + x))))[0]
        return divergence(other, [*shares.values(), 1 - sum(shares.values())],
                          F.col("n_words").cast("double"))

    by_word = {language: of_words(shares) for language, shares in word_shares.items()}
    return df.withColumns({
        "class_distance": F.when(F.col("_length") >= MIN_COMPARED_CHARACTERS,
                                 F.sqrt(of_language(by_class))),
        "word_distance": F.when(F.col("n_words") >= MIN_COMPARED_WORDS,
                                F.sqrt(of_language(by_word))),
    })


def of_language(by_language: Mapping[str, Column]) -> Column:
    """The value of the row's declared language, or the least of all where it has none."""
    found = None
    for language, value in by_language.items():
        is_it = F.col("lang") == language
        found = F.when(is_it, value) if found is None else found.when(is_it, value)
    return found.otherwise(least(list(by_language.values())))


def least(columns: Sequence[Column]) -> Column:
    return F.least(*columns) if len(columns) > 1 else columns[0]


def quality_rules(docs: DataFrame, max_class_distance: float = MAX_CLASS_DISTANCE,
                  max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Counts, both distances (null below the minimum length), ``base_failed`` and ``kept``."""
    df = with_distances(measured(docs.select("doc_id", "lang", "text")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    near = (F.coalesce(F.col("class_distance") <= max_class_distance, F.lit(True))
            & F.coalesce(F.col("word_distance") <= max_word_distance, F.lit(True)))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & near).alias("kept"),
        F.round("class_distance", 6).alias("class_distance"),
        F.round("word_distance", 6).alias("word_distance"))
