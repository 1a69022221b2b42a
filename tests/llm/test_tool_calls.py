import json

import pytest
from brute import as_dicts, rows
from compare import differences, duck
from pyspark.sql import functions as F

from tripmill.llm import oracles, queries
from tripmill.llm import tool_calls as T


def test_equals_sql(spark, sf_dir):
    assert differences(queries.op4_tool_call_linking(spark, sf_dir), duck(sf_dir),
                       oracles.all_sql()["op4_tool_call_linking"]) == []


def test_messages_are_canonical_json(spark, sf_dir):
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in rows(sf_dir, "conversations")}
    for r in as_dicts(queries.op4_tool_call_linking(spark, sf_dir)):
        message = json.loads(r["message"])
        plain = json.dumps(message, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert plain == r["message"]
        if r["turn"] is not None:
            assert message["arguments"]["question"] == texts[r["conv_id"], r["turn"]]


def linked(spark, calls, results=()):
    c = spark.createDataFrame(
        [(v, t, i, n, a if a is None or isinstance(a, str) else json.dumps(a), 1)
         for v, t, i, n, a in calls],
        "conv_id long, turn long, call_id string, name string, arguments string, level int")
    r = spark.createDataFrame(list(results),
                              "conv_id long, turn long, call_id string, content string")
    return as_dicts(T.serialised(T.link(c, r)))


GOOD = {"n_words": 5, "question": "q"}


def uses(*ids):
    return {**GOOD, "previous": {f"k{i}": {"$result": x} for i, x in enumerate(ids)}}


def test_order_of_chains_and_graphs(spark):
    chain = [(1, i, f"c{i}", "answer", uses(f"c{i - 1}") if i else GOOD) for i in range(37)]
    graph = [(2, 0, "a", "answer", GOOD), (2, 1, "b", "answer", uses("a")),
             (2, 2, "c", "answer", uses("a", "b")), (2, 3, "d", "answer", uses("c", "a", "b")),
             (2, 4, "e", "answer", uses("z", "d")), (2, 9, "z", "answer", uses("b"))]
    circle = [(3, 0, "p", "answer", uses("r")), (3, 1, "q", "answer", uses("p")),
              (3, 2, "r", "answer", uses("q")), (3, 3, "s", "answer", uses("p")),
              (3, 4, "t", "answer", uses("t")), (3, 5, "u", "answer", GOOD),
              (3, 6, "v", "answer", uses("u", "s"))]
    got = {(r["conv_id"], r["call_id"]): r for r in linked(spark, chain + graph + circle)}
    for i in range(37):
        assert got[1, f"c{i}"]["level"] == i
    assert [got[2, x]["level"] for x in "abczde"] == [0, 1, 2, 2, 3, 4]
    for x in "pqrstv":
        assert got[3, x]["level"] is None and got[3, x]["status"] == "circular"
    assert got[3, "u"]["level"] == 0


def test_a_ladder_with_two_references_each(spark):
    calls = [(1, i, f"c{i}", "answer", uses(*[f"c{j}" for j in (i - 1, i - 2) if j >= 0]))
             for i in range(12)]
    assert sorted(r["level"] for r in linked(spark, calls)) == list(range(12))


def test_arguments_and_status(spark):
    cases = {
        "ok": ("answer", GOOD, "unanswered", ""), "wide": ("answer", {**GOOD, "n_words": 61},
                                                         "invalid", "n_words: too large"),
        "none": ("answer", {"n_words": 1}, "invalid", "question: missing"),
        "kind": ("answer", {"n_words": "1", "question": 2}, "invalid",
                 "n_words: no integer; question: no string"),
        "half": ("answer", {"n_words": 1.5, "question": "q"}, "invalid", "n_words: no integer"),
        "more": ("answer", {**GOOD, "b": 1, "a": 2}, "invalid", "a: unknown; b: unknown"),
        "style": ("explain", {**GOOD, "style": "odd"}, "invalid", "style: not a choice"),
        "tool": ("other", GOOD, "invalid", "unknown tool"),
        "null": (None, GOOD, "invalid", "unknown tool"),
        "text": ("answer", "no json", "malformed", None), "list": ("answer", "[1]", "malformed", None),
        "nothing": ("answer", None, "malformed", None),
        "gone": ("answer", uses("nowhere"), "missing_reference", ""),
    }
    got = {r["call_id"]: r for r in linked(
        spark, [(1, i, k, c[0], c[1]) for i, (k, c) in enumerate(cases.items())])}
    for key, (_, _, status, errors) in cases.items():
        assert got[key]["status"] == status, key
        if errors is not None:
            assert got[key]["errors"] == errors, key


def test_results_duplicates_and_nulls(spark):
    calls = [(1, 3, "a", "answer", GOOD), (1, 2, "a", "answer", {**GOOD, "n_words": 7}),
             (None, 1, "a", "answer", GOOD), (1, 4, None, "answer", GOOD), (4, 0, "b", "answer", GOOD),
             (4, 0, "b", "answer", GOOD)]
    results = [(1, 9, "a", "late"), (1, 5, "a", "soon"), (None, 2, "a", "of null"), (1, 5, "x", "lost"),
               (1, 6, None, "no id"), (4, 1, "b", None)]
    got = linked(spark, calls, results)
    seen = sorted((str(r["conv_id"]), str(r["turn"]), r["status"], str(r["result"])) for r in got)
    assert seen == sorted([
        ("1", "3", "duplicate", "soon"), ("1", "2", "linked", "soon"), ("None", "1", "linked", "of null"),
        ("1", "4", "malformed", "None"), ("4", "0", "linked", "None"), ("4", "0", "linked", "None"),
        ("1", "None", "orphan", "lost")])
    assert linked(spark, []) == []


def test_canonical_arguments(spark):
    row = linked(spark, [(1, 0, "a", "answer", '{ "z": [1, {"y":2,"x":3}], "a": "é\\n\\"" }')])[0]
    assert row["arguments"] == '{"a":"é\\n\\"","z":[1,{"x":3,"y":2}]}'


def statuses(found):
    return sorted((str(r["conv_id"]), str(r["turn"]), r["status"], str(r["result_turn"]),
                   str(r["result"])) for r in as_dicts(found))


def test_dialogues_without_conversation_or_turn(spark):
    df = spark.createDataFrame(
        [(None, 0, "user", "one"), (None, 1, "assistant", "answer one"),
         (None, 2, "user", "one two three"), (None, 3, "assistant", "answer two"),
         (5, None, "user", "lost"), (5, None, "assistant", "found"), (5, None, "assistant", "too")],
        "conv_id long, turn long, role string, text string")
    got = T.link_messages(T.as_tool_messages(df))
    assert statuses(got) == sorted([
        ("None", "0", "linked", "1", "answer one"), ("None", "2", "linked", "3", "answer two"),
        ("5", "None", "malformed", "None", "None"),
        ("5", "None", "orphan", "None", "found"), ("5", "None", "orphan", "None", "too")])
    assert sorted(r["level"] for r in as_dicts(got) if r["level"] is not None) == [0, 1]


def test_no_message_vanishes(spark):
    call = json.dumps({"tool_calls": [{"id": "a", "name": "answer", "arguments": json.dumps(GOOD)}]})
    df = spark.createDataFrame(
        [(1, 0, "assistant", call), (1, 1, "tool", '{"tool_call_id":"a","content":"yes"}'),
         (1, 2, "assistant", '{"tool_calls":[{"id":"b"'), (1, 3, "assistant", '{"tool_calls":"b"}'),
         (1, 4, "assistant", '{"content":"no call"}'), (1, 5, "tool", "no json"),
         (1, 6, "tool", '{"content":"no id"}'), (1, 7, "assistant", None), (1, 8, "tool", None)],
        "conv_id long, turn long, role string, text string")
    assert statuses(T.link_messages(df)) == sorted([
        ("1", "0", "linked", "1", "yes"), ("1", "2", "malformed", "None", "None"),
        ("1", "3", "malformed", "None", "None"), ("1", "7", "malformed", "None", "None"),
        ("1", "None", "orphan", "5", "no json"), ("1", "None", "orphan", "6", "no id"),
        ("1", "None", "orphan", "8", "None")])


@pytest.mark.parametrize("kind", ["string", "integer", "number", "boolean", "object", "array"])
def test_a_reference_may_stand_for_any_kind(spark, kind):
    schemas = {"t": {"x": T.Parameter(kind, least=1, most=2, choices=("a",))
                     if kind in ("integer", "number") else T.Parameter(kind)}}
    texts = ['{"x":{"$result":"a"}}', '{"x": { "$result" : "a" } }', '{"x":{"$result":"a","y":1}}',
             '{"x":{"$result":5}}', "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "arguments string")
    got = [r.e for r in df.select(T.argument_errors(
        F.lit("t"), F.col("arguments"), schemas).alias("e")).collect()]
    assert got[:2] == [[], []] and got[4] == ["x: missing"]
    wrong = [] if kind == "object" else [f"x: no {kind}"]
    assert got[2] == wrong


def test_a_typed_argument_is_linked_by_its_reference(spark):
    calls = spark.createDataFrame(
        [(1, 0, "a", "answer", '{"question":"q","n_words":3}'),
         (1, 2, "b", "answer", '{"question":{"$result":"a"},"n_words":{"$result":"a"}}')],
        "conv_id long, turn long, call_id string, name string, arguments string")
    results = spark.createDataFrame([(1, 1, "a", "r"), (1, 3, "b", "s")],
                                    "conv_id long, turn long, call_id string, content string")
    got = {r["call_id"]: (r["level"], r["status"]) for r in T.link(calls, results).collect()}
    assert got == {"a": (0, "linked"), "b": (1, "linked")}
