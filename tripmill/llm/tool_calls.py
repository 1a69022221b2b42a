"""Tool-call linking: calls and their results joined by identifier, ordered, validated, serialised.

Calls and results of all conversations are hash-joined on conversation and call id. A call can use the
result of another one by an argument ``{"$result": "<call id>"}``; these references give the order: a
call stands one level above the highest call it refers to. A reference may stand for an argument of any
kind. Levels are found by pointer doubling: a
reference to a call that itself has a single open reference jumps to the end of that one, so a chain
of n calls takes log2(n) rounds, each a join of written tables. Arguments are validated against the
tools' schemas and serialised as canonical JSON (keys in order, no spaces). DataFrame and SQL
functions do all of it.

A conversation with a third of all rows is no group of its own anywhere: joins and aggregates go by
conversation and call id.

Defined cases: a call without id, or with arguments that are no JSON object, is ``malformed``; of calls
with one id the one with the smallest turn (then arguments) counts and the others are ``duplicate``;
of several results the earliest counts; results without a call are ``orphan`` rows; a call that no
result answers is ``unanswered``; a reference to no call is ``missing_reference``; calls in or above a
circle have no level and are ``circular``. Null conversation ids are one conversation; rows repeated in
full are the same call and get the same row each; empty tables give an empty result; other columns are
not read.

Of messages (``link_messages``) none vanishes: an assistant message that is no JSON, or whose
``tool_calls`` are no list of objects, is a ``malformed`` row; a JSON object without ``tool_calls`` has
no call; each result without an id is an ``orphan`` row of its own, with the whole text as the result
if it is no JSON. ``link`` itself takes results with an id only. A dialogue turn without a number has
no place before or after others: its call is ``malformed``, its result an ``orphan``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import n_words, written
from tripmill.session import fresh_folder


@dataclass(frozen=True)
class Parameter:
    """One argument of a tool: kind is string, integer, number, boolean, object or array."""

    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None
    choices: Sequence[str] = ()


Schemas = Mapping[str, Mapping[str, Parameter]]

# --- parameters of the registered query -------------------------------------------------------------
SCHEMAS: Schemas = {
    "answer": {"question": Parameter("string"), "n_words": Parameter("integer", least=1, most=60),
               "previous": Parameter("object", required=False)},
    "explain": {"question": Parameter("string"), "n_words": Parameter("integer", least=1),
                "style": Parameter("string", choices=("short", "long")),
                "previous": Parameter("object", required=False)},
}
KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\([0-9]+,0\\))$",
         "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$",
         "object": "^OBJECT<", "array": "^ARRAY<"}
CALL = ("conv_id", "call_id")


def calls_of(messages: DataFrame) -> DataFrame:
    """Calls in assistant messages of the form ``{"tool_calls": [{"id", "name", "arguments"}]}``."""
    kind = "array<struct<id string, name string, arguments string>>"
    value = F.try_parse_json("text")
    # A list that cannot be read is one call of which nothing is known.
    unread = value.isNull() | F.try_variant_get(value, "$.tool_calls", "variant").isNotNull()
    parsed = messages.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.from_json("text", f"tool_calls {kind}").alias("_m"),
        unread.alias("_unread"))
    calls = F.coalesce("_m.tool_calls", F.when(F.col("_unread"), F.array(F.lit(None))).cast(kind))
    return parsed.select("conv_id", "turn", F.explode(calls).alias("_c")).select(
        "conv_id", "turn", F.col("_c.id").alias("call_id"), F.col("_c.name").alias("name"),
        F.col("_c.arguments").alias("arguments"))


def results_of(messages: DataFrame) -> DataFrame:
    """Results in tool messages of the form ``{"tool_call_id", "content"}``; a text that is no JSON is
    all content."""
    parsed = messages.where(F.col("role") == "tool").select(
        "conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("_m"),
        F.when(F.try_parse_json("text").isNull(), F.col("text")).alias("_text"))
    whole = F.col("_text").isNotNull()
    return parsed.select("conv_id", "turn", F.when(~whole, F.col("_m.tool_call_id")).alias("call_id"),
                         F.when(whole, F.col("_text")).otherwise(F.col("_m.content")).alias("content"))


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Plain dialogues as tool messages: each user turn is a call that refers to the call of the
    previous user turn, each assistant turn the result of the call in the turn before it.

    The tool is ``answer``, ``explain`` or an unknown one by the number of words modulo 3; ``explain``
    asks for a style that may be none of the allowed ones.
    """
    words = n_words(F.col("text"))

    def call_id(turn: Column) -> Column:
        # Null conversation ids are one conversation, so its calls have ids as well.
        return F.concat(F.lit("call-"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")),
                        F.lit("-"), turn.cast("string"))

    turns = F.col("turn")
    earlier = F.when(turns >= 2, F.struct(call_id(turns - 2).alias("$result")))
    tool = F.element_at(F.array(F.lit("answer"), F.lit("explain"), F.lit("guess")),
                        (words % 3 + 1).cast("int"))
    style = F.when(words % 3 == 1, F.element_at(
        F.array(F.lit("short"), F.lit("long"), F.lit("odd")), (words % 4 % 3 + 1).cast("int")))
    arguments = F.to_json(F.struct(
        F.col("text").alias("question"), words.alias("n_words"), style.alias("style"),
        earlier.alias("previous")))
    call = F.to_json(F.struct(F.array(F.struct(
        call_id(turns).alias("id"), tool.alias("name"), arguments.alias("arguments")))
        .alias("tool_calls")))
    result = F.to_json(F.struct(call_id(turns - 1).alias("tool_call_id"),
                                F.col("text").alias("content")))
    asked, answered = F.col("role") == "user", F.col("role") == "assistant"
    return conversations.where(asked | answered).select(
        "conv_id", "turn", F.when(asked, "assistant").otherwise("tool").alias("role"),
        F.when(asked, call).otherwise(result).alias("text"))


def references(arguments: Column) -> Column:
    """Ids in ``{"$result": id}`` arguments, at any depth of the JSON text."""
    return F.array_distinct(F.regexp_extract_all(
        arguments, F.lit(r'\{\s*"\$result"\s*:\s*"([^"\\]*)"\s*\}')))


def is_reference(part: Column) -> Column:
    """Whether a variant is ``{"$result": id}`` and nothing else."""
    return F.coalesce(F.try_variant_get(part, "$['$result']", "string").isNotNull() & (
        F.size(F.json_object_keys(F.to_json(part))) == 1), F.lit(False))


def argument_errors(name: Column, arguments: Column, schemas: Schemas = SCHEMAS) -> Column:
    """What is wrong with the arguments of a tool, in order of the names; empty if nothing is."""
    value = F.try_parse_json(arguments)
    found = F.array(F.lit("unknown tool"))
    for tool, parameters in schemas.items():
        errors = []
        for parameter, rule in sorted(parameters.items()):
            path = f"$['{parameter}']"
            part = F.try_variant_get(value, path, "variant")
            kind = F.schema_of_variant(part)
            absent = part.isNull()
            number = F.try_variant_get(value, path, "double")
            text = F.try_variant_get(value, path, "string")
            # A reference stands for a value that is not there yet, of whatever kind.
            error = F.when(absent, f"{parameter}: missing" if rule.required else None).when(
                is_reference(part), F.lit(None)).when(
                ~kind.rlike(KINDS[rule.kind]), f"{parameter}: no {rule.kind}")
            if rule.least is not None:
                error = error.when(number < rule.least, f"{parameter}: too small")
            if rule.most is not None:
                error = error.when(number > rule.most, f"{parameter}: too large")
            if rule.choices:
                error = error.when(~text.isin(*rule.choices), f"{parameter}: not a choice")
            errors.append(error)
        extra = F.array_sort(F.array_except(
            F.json_object_keys(arguments), F.array(*[F.lit(p) for p in sorted(parameters)])))
        known = F.concat(F.array_compact(F.array(*errors)),
                         F.transform(extra, lambda key: F.concat(key, F.lit(": unknown"))))
        found = F.when(name == tool, known).otherwise(found)
    return found


def canonical(arguments: Column) -> Column:
    """JSON with keys in order and no spaces; null if it is none."""
    return F.to_json(F.try_parse_json(arguments))


def levels(edges: DataFrame, calls: DataFrame) -> DataFrame:
    """Level of every call in ``edges`` (conv_id, call_id, to: one row a reference); null in or above a
    circle. ``calls`` are all calls (conv_id, call_id)."""
    spark = edges.sparkSession
    # A path longer than the longest conversation goes in a circle.
    longest = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    open_edges = written(edges.withColumn("steps", F.lit(1).cast("long")),
                         fresh_folder(spark, "references"))
    # What is known of a call so far: its level is at least this.
    floor = written(calls.select(*CALL).distinct().withColumn("at_least", F.lit(0).cast("long"))
                    .withColumn("circular", F.lit(False)), fresh_folder(spark, "levels"))
    while True:
        waiting = open_edges.groupBy(*CALL).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("to", "steps")).alias("only"))
        state = floor.alias("f").join(waiting.alias("w"), same("f", "w"), "left").select(
            F.col("f.conv_id").alias("conv_id"), F.col("f.call_id").alias("to"),
            "at_least", "circular", F.coalesce("n", F.lit(0)).alias("n"), "only")
        met = open_edges.alias("e").join(
            state.alias("s"), F.col("e.conv_id").eqNullSafe(F.col("s.conv_id"))
            & (F.col("e.to") == F.col("s.to"))).select(
            "e.*", "s.at_least", "s.n", "s.only",
            (F.col("s.circular") | (F.col("e.steps") > longest)).alias("circular"))
        met = written(met, fresh_folder(spark, "met"))
        gained = met.where((F.col("n") <= 1) | F.col("circular")).groupBy(*CALL).agg(
            F.max(F.col("at_least") + F.col("steps")).alias("_gain"),
            F.max("circular").alias("_circular"))
        floor = written(floor.alias("f").join(gained.alias("g"), same("f", "g"), "left").select(
            "f.conv_id", "f.call_id", F.greatest("at_least", F.coalesce("_gain", F.lit(0)))
            .alias("at_least"), (F.col("circular") | F.coalesce("_circular", F.lit(False)))
            .alias("circular")), fresh_folder(spark, "levels"))
        jumped = met.where((F.col("n") == 1) & ~F.col("circular")).select(
            *CALL, F.col("only.to").alias("to"), (F.col("steps") + F.col("only.steps"))
            .alias("steps"))
        stayed = met.where((F.col("n") > 1) & ~F.col("circular")).select(*CALL, "to", "steps")
        before = open_edges
        open_edges = written(jumped.unionByName(stayed).groupBy(*CALL, "to").agg(
            F.max("steps").alias("steps")), fresh_folder(spark, "references"))
        if open_edges.isEmpty():
            break
        if jumped.isEmpty() and open_edges.count() == before.count():
            # Nothing can move: what is left waits for itself.
            stuck = open_edges.select(*CALL).distinct().withColumn("_stuck", F.lit(True))
            floor = floor.alias("f").join(stuck.alias("s"), same("f", "s"), "left").select(
                "f.conv_id", "f.call_id", "at_least",
                (F.col("circular") | F.coalesce("_stuck", F.lit(False))).alias("circular"))
            break
    return floor.select(*CALL, F.when(~F.col("circular"), F.col("at_least")).alias("level"))


def same(a: str, b: str) -> Column:
    """Same conversation and call."""
    return (F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
            & (F.col(f"{a}.call_id") == F.col(f"{b}.call_id")))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """One row per call, and per result without a call; conv_id, level and turn give their order, the
    rows themselves come in none."""
    spark = calls.sparkSession
    rows = written(calls.select("conv_id", "turn", "call_id", "name", "arguments"),
                   fresh_folder(spark, "calls"))
    sorted_key = F.struct("turn", "arguments", "name")
    firsts = rows.where(F.col("call_id").isNotNull()).groupBy(*CALL).agg(
        F.min(sorted_key).alias("first"), F.count(F.lit(1)).alias("_n"))
    firsts = written(firsts, fresh_folder(spark, "firsts"))
    answers = results.where(F.col("call_id").isNotNull()).groupBy(*CALL).agg(
        F.min(F.struct("turn", "content")).alias("answer"), F.count(F.lit(1)).alias("n_results"))
    answers = written(answers, fresh_folder(spark, "answers"))

    used = firsts.select(*CALL, F.explode(references(F.col("first.arguments"))).alias("to"))
    target = firsts.select("conv_id", F.col("call_id").alias("to"))
    there = F.col("u.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("u.to") == F.col("t.to"))
    edges = used.alias("u").join(target.alias("t"), there, "left_semi")
    missing = used.alias("u").join(target.alias("t"), there, "left_anti").select(*CALL).distinct() \
        .withColumn("_missing", F.lit(True))
    level = levels(edges, firsts)

    each = rows.alias("r").join(firsts.alias("f"), same("r", "f"), "left").join(
        answers.alias("a"), same("r", "a"), "left").join(
        level.alias("l"), same("r", "l"), "left").join(missing.alias("m"), same("r", "m"), "left")
    shape = canonical(F.col("r.arguments"))
    errors = argument_errors(F.col("r.name"), F.col("r.arguments"), schemas)
    counts = F.struct("r.turn", "r.arguments", "r.name").eqNullSafe(F.col("f.first"))
    status = (
        F.when(F.col("r.call_id").isNull() | shape.isNull() | ~shape.startswith("{"), "malformed")
        .when(~counts | F.col("f._n").isNull(), "duplicate")
        .when(F.col("l.level").isNull(), "circular")
        .when(F.col("_missing"), "missing_reference")
        .when(F.size(errors) > 0, "invalid")
        .when(F.col("a.n_results").isNull(), "unanswered").otherwise("linked"))
    linked = each.select(
        "r.conv_id", "r.turn", "r.call_id", "r.name", shape.alias("arguments"), "l.level",
        F.array_join(F.when(F.col("r.name").isNull(), F.array(F.lit("unknown tool")))
                     .otherwise(errors), "; ").alias("errors"),
        F.col("a.answer.turn").alias("result_turn"), F.col("a.answer.content").alias("result"),
        F.coalesce("a.n_results", F.lit(0)).alias("n_results"), status.alias("status"))
    orphans = answers.alias("a").join(firsts.alias("f"), same("a", "f"), "left_anti").select(
        "conv_id", "call_id", "answer", "n_results")
    return linked.unionByName(_orphans(orphans))


def _orphans(answers: DataFrame) -> DataFrame:
    """Rows of results without a call (conv_id, call_id, answer, n_results)."""
    return answers.select(
        "conv_id", F.lit(None).cast("long").alias("turn"), "call_id",
        F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("long").alias("level"), F.lit("").alias("errors"),
        F.col("answer.turn").alias("result_turn"), F.col("answer.content").alias("result"),
        "n_results", F.lit("orphan").alias("status"))


def link_messages(messages: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """The calls and results of messages linked; results without an id are rows as well."""
    results = results_of(messages)
    nameless = results.where(F.col("call_id").isNull()).select(
        "conv_id", "call_id", F.struct("turn", "content").alias("answer"),
        F.lit(1).cast("long").alias("n_results"))
    return link(calls_of(messages), results, schemas).unionByName(_orphans(nameless))


def serialised(linked: DataFrame) -> DataFrame:
    """Add ``message``: the call with its result as canonical JSON."""
    def text(value: Column) -> Column:
        # The JSON text of a string, as an element of an array without its brackets.
        listed = F.to_json(F.array(F.coalesce(value, F.lit(""))))
        return F.substr(listed, F.lit(2), F.length(listed) - 2)

    call = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'),
        text(F.col("call_id")), F.lit(',"name":'), text(F.col("name")), F.lit(',"result":'),
        F.when(F.col("n_results") > 0, text(F.col("result"))).otherwise("null"), F.lit("}"))
    return linked.withColumn("message", call)
