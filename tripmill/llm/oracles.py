"""SQL of the text queries that SQL can state, written for DuckDB over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from tripmill.llm import (
    knn, mixing, quality, queries, runs, tool_calls, url_rules, variants, warc,
)
from tripmill.llm.common import WORD


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {quoted(WORD)})"


# ---- op1 -------------------------------------------------------------------------------------------

def url_filter() -> str:
    rules = sorted(url_rules.HOST_RULES, key=lambda r: -len(r.name))
    fits = [(f"(host = {quoted(r.host)} OR ends_with(host, {quoted('.' + r.host)})) "
             f"AND starts_with(path, {quoted(r.path)})", r) for r in rules]
    ordered = sorted(url_rules.PATTERN_RULES, key=lambda p: not p.startswith("@@"))
    patterns = " ".join(
        f"WHEN regexp_matches(low, {quoted(url_rules.regex_of(p.removeprefix('@@')))}, 's') "
        f"THEN {quoted(p)}" for p in ordered)
    return f"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS low,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (
  SELECT page_id, host, path,
         CASE {" ".join(f"WHEN {w} THEN {quoted(r.name)}" for w, r in fits)} END AS rule,
         CASE {" ".join(f"WHEN {w} THEN {quoted(r.verdict)}" for w, r in fits)} END AS ruled,
         CASE {patterns} END AS pattern
  FROM parts)
SELECT page_id, host, path, rule, pattern,
       coalesce(ruled, CASE WHEN pattern IS NULL OR starts_with(pattern, '@@') THEN 'allow'
                       ELSE 'block' END) AS verdict
FROM judged"""


# ---- op2 -------------------------------------------------------------------------------------------

KNN = f"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding,
           lambda x: floor({knn.SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM whole q JOIN whole d ON q.vec_id <> d.vec_id
  WHERE q.vec_id % {queries.QUERY_EVERY} = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= {knn.K}"""


# ---- op3 -------------------------------------------------------------------------------------------

def _divergence(counts: Sequence[str], shares: Sequence[float], total: str) -> str:
    parts = []
    for count, share in zip(counts, shares, strict=True):
        p, q = f"(({count}) / CAST({total} AS DOUBLE))", f"CAST({share!r} AS DOUBLE)"
        m = f"(({p} + {q}) / 2)"
        parts.append(f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / {m}) ELSE 0 END"
                     f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / {m}) ELSE 0 END)")
    return f"greatest(({' + '.join(parts)}) / 2, 0)"


def _of_language(by_language: dict[str, str]) -> str:
    cases = " ".join(f"WHEN lang = {quoted(k)} THEN {v}" for k, v in by_language.items())
    return f"CASE {cases} ELSE least({', '.join(by_language.values())}) END"


def divergence_rules() -> str:
    common = sorted({w for s in quality.WORD_SHARES.values() for w in s})
    counted = ", ".join(f"len(list_filter(w, lambda x: x = {quoted(c)})) AS c{i}"
                        for i, c in enumerate(common))
    classes = ", ".join(f"len(regexp_extract_all(t, {quoted(p)})) AS k_{n}"
                        for n, p in quality.CLASSES.items())
    names = [f"k_{n}" for n in quality.CLASSES]
    bins = ["chars - word_chars", *names, "n_symbols",
            f"word_chars - n_symbols - {' - '.join(names)}"]
    by_class = {k: _divergence(bins, v, "chars") for k, v in quality.CLASS_SHARES.items()}
    by_word = {}
    for language, shares in quality.WORD_SHARES.items():
        columns = [f"c{common.index(w)}" for w in shares]
        by_word[language] = _divergence(
            [*columns, f"n_words - {' - '.join(columns)}"],
            [*shares.values(), 1 - sum(shares.values())], "n_words")
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS t,
         {words('text')} AS w FROM documents),
counts AS (
  SELECT row_id, doc_id, lang, length(t) AS chars, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         len(regexp_extract_all(t, {quoted(quality.SYMBOLS)})) AS n_symbols,
         list_filter(string_split(t, chr(10)),
                     lambda l: regexp_matches(l, {quoted(WORD)})) AS lines,
         {classes}, {counted}
  FROM texts),
windows AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w[i], w[i + 1], w[i + 2]) AS n
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts)),
repeats AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY row_id),
measured AS (
  SELECT c.*, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CASE WHEN chars >= {quality.MIN_COMPARED_CHARACTERS}
              THEN sqrt({_of_language(by_class)}) END AS class_distance,
         CASE WHEN n_words >= {quality.MIN_COMPARED_WORDS}
              THEN sqrt({_of_language(by_word)}) END AS word_distance
  FROM counts c LEFT JOIN repeats USING (row_id)),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(class_distance <= {quality.MAX_CLASS_DISTANCE}, true)
       AND coalesce(word_distance <= {quality.MAX_WORD_DISTANCE}, true) AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM judged"""


# ---- op4 -------------------------------------------------------------------------------------------

def tool_call_linking() -> str:
    least, most = 1, int(tool_calls.SCHEMAS["answer"]["n_words"].most)
    return f"""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, len({words('text')}) AS n,
         'call-' || conv_id || '-' || turn AS own, 'call-' || conv_id || '-' || (turn - 1) AS before,
         CASE WHEN turn >= 2 THEN 'call-' || conv_id || '-' || (turn - 2) END AS earlier
  FROM conversations),
calls AS (
  SELECT *, ['answer', 'explain', 'guess'][n % 3 + 1] AS name,
         CASE WHEN n % 3 = 1 THEN ['short', 'long', 'odd'][n % 4 % 3 + 1] END AS style
  FROM turns WHERE role = 'user'),
results AS (SELECT * FROM turns WHERE role = 'assistant'),
levels AS (
  SELECT own, CAST(0 AS BIGINT) AS level FROM calls
  WHERE earlier IS NULL OR earlier NOT IN (SELECT own FROM calls)
  UNION ALL
  SELECT c.own, l.level + 1 FROM calls c JOIN levels l ON c.earlier = l.own),
checked AS (
  SELECT c.conv_id, c.turn, c.own AS call_id, c.name, l.level,
         array_to_string(list_filter([
           CASE WHEN name = 'guess' THEN 'unknown tool'
                WHEN c.n < {least} THEN 'n_words: too small'
                WHEN name = 'answer' AND c.n > {most} THEN 'n_words: too large' END,
           CASE WHEN name <> 'guess' AND c.text IS NULL THEN 'question: missing' END,
           CASE WHEN style = 'odd' THEN 'style: not a choice' END],
           lambda e: e IS NOT NULL), '; ') AS errors,
         c.earlier IS NOT NULL AND c.earlier NOT IN (SELECT own FROM calls) AS lost,
         r.turn AS result_turn, r.text AS result, r.own IS NOT NULL AS answered,
         '{{"n_words":' || c.n
         || CASE WHEN c.earlier IS NOT NULL THEN ',"previous":{{"$result":"' || c.earlier || '"}}'
            ELSE '' END
         || CASE WHEN c.text IS NOT NULL THEN ',"question":' || CAST(to_json(c.text) AS VARCHAR)
            ELSE '' END
         || CASE WHEN style IS NOT NULL THEN ',"style":"' || style || '"' ELSE '' END
         || '}}' AS arguments
  FROM calls c JOIN levels l USING (own) LEFT JOIN results r ON r.before = c.own)
SELECT conv_id, turn, call_id, name, level, errors, result_turn,
       CAST(answered AS BIGINT) AS n_results,
       CASE WHEN lost THEN 'missing_reference' WHEN errors <> '' THEN 'invalid'
            WHEN NOT answered THEN 'unanswered' ELSE 'linked' END AS status,
       '{{"arguments":' || arguments || ',"id":"' || call_id || '","name":"' || name || '","result":'
       || CASE WHEN answered THEN CAST(to_json(coalesce(result, '')) AS VARCHAR) ELSE 'null' END
       || '}}' AS message
FROM checked
UNION ALL
SELECT conv_id, NULL, before, NULL, NULL, '', turn, 1, 'orphan',
       '{{"arguments":null,"id":"' || before || '","name":"","result":'
       || CAST(to_json(coalesce(text, '')) AS VARCHAR) || '}}'
FROM results WHERE before NOT IN (SELECT own FROM calls)"""


# ---- op7 -------------------------------------------------------------------------------------------

ARCHIVED = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
held AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS holder FROM payloads),
typed AS (
  SELECT *, payload_bytes >= {warc.MIN_REVISIT} AND holder IS NOT NULL
            AND page_id IS DISTINCT FROM holder AS again FROM held)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN holder END AS refers_to, true AS intact
FROM typed"""


# ---- op8 -------------------------------------------------------------------------------------------

MIXED = f"""
WITH RECURSIVE sized AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, len({words('text')}) AS size,
         substring(md5('{mixing.SEED}-' || coalesce(CAST(doc_id AS VARCHAR) || '-', '')
                       || md5(coalesce(text, ''))), 1, 16) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, {list(mixing.WEIGHTS)}[place % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight,
         {mixing.MOST} * CAST(source_size AS DOUBLE) AS most FROM sources),
rates AS (
  SELECT 0 AS step, (SELECT CAST({mixing.SHARE} AS DOUBLE) * sum(source_size) / sum(weight)
                     FROM weighed) AS rate
  UNION ALL
  SELECT step + 1, (SELECT (CAST({mixing.SHARE} AS DOUBLE) * sum(source_size)
                            - sum(CASE WHEN weight * r.rate > most THEN most ELSE 0 END))
                           / sum(CASE WHEN weight * r.rate > most THEN 0 ELSE weight END)
                    FROM weighed)
  FROM rates r WHERE step < 40),
targets AS (
  SELECT source, source_size, place,
         least(weight * (SELECT rate FROM rates WHERE step = 40), most) AS target FROM weighed),
queued AS (
  SELECT s.*, t.place, t.target, t.source_size,
         sum(s.size) OVER (PARTITION BY t.place ORDER BY s.key, s.size, coalesce(s.doc_id, 0)
                           ROWS UNBOUNDED PRECEDING) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source WHERE s.size > 0),
copies AS (
  SELECT *, (CAST(ahead AS DOUBLE) + (copy - 1) * source_size) / target AS finish
  FROM queued CROSS JOIN (SELECT unnest(range(1, {mixing.MOST} + 1)) AS copy)),
ordered AS (
  SELECT row_id, sum(size) OVER (ORDER BY finish, place, copy, key, coalesce(doc_id, 0)
                                 ROWS UNBOUNDED PRECEDING) AS total FROM copies),
taken AS (
  SELECT row_id, count(*) AS n FROM ordered
  WHERE total <= (SELECT sum(target) FROM targets) + 0.25 GROUP BY row_id)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, t.source_size, t.target,
       CAST(s.size * coalesce(k.n, 0) AS BIGINT) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
LEFT JOIN taken k USING (row_id)"""


# ---- checksums -------------------------------------------------------------------------------------

def _crc_table() -> list[int]:
    """What CRC-32 adds for each byte, by its rule: eight divisions by the reversed polynomial."""
    def divided(x: int) -> int:
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        return x
    return [divided(i) for i in range(256)]


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes."""
    table = f"CAST({_crc_table()} AS BIGINT[])"
    size = f"octet_length(encode({text}))"
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    parts = f"list_prepend(4294967295::BIGINT, list_transform(range({size}), lambda i: {byte}))"
    return (f"xor(list_reduce({parts}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), "
            "4294967295::BIGINT)")


# ---- op11 ------------------------------------------------------------------------------------------

def main_text() -> str:
    """The article of these pages, which all have one, by its tag."""
    decoded = "x"
    for reference, character in (("&amp;", "\x01"), ("&amp", "\x01"), ("&quot;", '"'), ("&lt;", "<"),
                                 ("&gt;", ">"), ("&#39;", "'"), ("\x01", "&")):
        decoded = f"replace({decoded}, {quoted(reference)}, {quoted(character)})"
    return rf"""
WITH split AS (
  SELECT page_id, url, string_split_regex(
           regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1),
           '</?(?:p|h1)>') AS blocks
  FROM pages),
plain AS (
  SELECT page_id, url, list_filter(list_transform(list_transform(blocks,
           lambda x: regexp_replace(x, '<[^>]*>', '', 'g')),
           lambda x: trim(regexp_replace({decoded}, '\s+', ' ', 'g'))), lambda x: x <> '') AS blocks
  FROM split),
joined AS (
  SELECT page_id, url, coalesce(array_to_string(blocks, chr(10)), '') AS text FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined"""


# ---- op12 ------------------------------------------------------------------------------------------

def periodic_runs() -> str:
    """Stretches of words that equal those q further on, for every q up to a quarter of the text."""
    return f"""
WITH given AS (
  SELECT doc_id, {words("text")} AS w, {crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
shaped AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS made,
         (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS e FROM given),
texts AS (
  SELECT doc_id, n, CASE WHEN made THEN list_transform(range(n), lambda i:
           w[1 + (CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + e)) ELSE i END)])
           ELSE w END AS w
  FROM shaped),
placed AS (
  SELECT doc_id, n, unnest(w) AS w, unnest(range(n)) AS i FROM texts),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q
  FROM placed x JOIN placed y ON x.doc_id = y.doc_id AND x.w = y.w
       AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands
  GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest({runs.LEAST_WORDS}, {runs.REPEATS} * q)),
found AS (
  SELECT s.* FROM stretches s ANTI JOIN stretches t ON t.doc_id = s.doc_id AND t.q < s.q
    AND s.q % t.q = 0 AND t.start <= s.start AND t.start + t.length >= s.start + s.length),
dropped AS (
  SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM found),
kept AS (
  SELECT p.doc_id, string_agg(p.w, ' ' ORDER BY p.i) AS collapsed
  FROM placed p ANTI JOIN dropped d ON p.doc_id = d.doc_id AND p.i = d.i GROUP BY p.doc_id),
told AS (
  SELECT doc_id, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS listed
  FROM found GROUP BY doc_id),
best AS (
  SELECT * FROM found
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / q DESC, start, q) = 1)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.q AS period,
       1000 * b.length // b.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN told USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept USING (doc_id)"""


# ---- op13 ------------------------------------------------------------------------------------------

def spelling_variants() -> str:
    """Near words by what is left when any one code point is deleted."""
    low = f"translate(run, {quoted(variants.UPPER)}, {quoted(variants.LOWER)})"
    return f"""
WITH RECURSIVE given AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), {quoted(variants.LETTERS)})) AS run
  FROM documents),
lowered AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || {low} AS mark, {low} AS run FROM given),
told AS (
  SELECT run, count(*) AS n, {crc32("mark")} AS h FROM lowered GROUP BY mark, run),
spelt AS (
  SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END
           AS word, n FROM told),
vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt
  WHERE length(word) >= {variants.LEAST_LENGTH}
  GROUP BY word HAVING sum(n) >= {variants.LEAST_COUNT}),
shorter AS (
  SELECT word, n, unnest(list_transform(range(length(word)),
           lambda i: word[:i] || word[i + 2:])) AS rest, unnest(range(length(word))) AS i
  FROM vocabulary),
near AS (
  SELECT x.word, y.word AS near FROM shorter x JOIN shorter y ON x.rest = y.rest AND x.i = y.i
  WHERE x.word <> y.word
  UNION SELECT x.word, v.word FROM shorter x JOIN vocabulary v ON x.rest = v.word
  UNION SELECT v.word, x.word FROM shorter x JOIN vocabulary v ON x.rest = v.word),
counted AS (
  SELECT near.word, v.word AS near, v.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near
  FROM near JOIN vocabulary v ON near.near = v.word),
best AS (
  SELECT * FROM counted
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= {variants.LEAST_RATIO} * v.n THEN near END AS form,
         CASE WHEN near_n >= {variants.LEAST_RATIO} * v.n THEN near_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS place FROM formed
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN formed f ON c.place = f.word WHERE f.form IS NOT NULL),
ends AS (
  SELECT c.word, c.place AS root FROM chain c JOIN formed f ON c.place = f.word
  WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)"""


def all_sql() -> dict[str, str]:
    return {
        "op1_url_filter": url_filter(),
        "op2_voronoi_knn": KNN,
        "op3_distribution_divergence": divergence_rules(),
        "op4_tool_call_linking": tool_call_linking(),
        "op7_gzip_normaliser": ARCHIVED,
        "op8_fair_queueing": MIXED,
        "op11_tree_marginals": main_text(),
        "op12_multiscale_minimizers": periodic_runs(),
        "op13_search_schemes": spelling_variants(),
    }
