import json
from collections import Counter

from tailwake.llm import chat

SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "o": ("object", False)}}
CALLS = "conv_id long, call_id string, turn long, function string, arguments string, after string"
RESULTS = "conv_id long, call_id string, turn long, content string"
GOOD = '{"b":1, "a":1}'


def linked(spark, calls, results):
    found = chat.link_calls(
        spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS
    )
    return {(r["conv_id"], r["call_id"], r["call_turn"]): r for r in found.collect()}


def test_links_levels_and_messages(spark):
    found = linked(
        spark,
        [
            (1, "a", 0, "add", '{"b": 1.5, "a": 2}', None),
            (1, "b", 2, "add", '{"a":1,"b":2,"o":{"z":1,"y":[1,{"q":2,"p":3}]}}', "a"),
            (2, "b", 2, "add", GOOD, "a"),
        ],
        [(1, "a", 1, "r1"), (1, "a", 3, "r2"), (1, "b", 3, None), (2, "b", 1, "early")],
    )
    a, b, other = found[1, "a", 0], found[1, "b", 2], found[2, "b", 2]
    assert (a["status"], a["level"], b["level"], other["level"]) == ("linked", 0, 1, 0)
    assert a["message"] == '{"arguments":{"a":2,"b":1.5},"function":"add","id":"a","result":"r1"}'
    assert '"o":{"y":[1,{"p":3,"q":2}],"z":1}' in b["message"]
    assert other["status"] == "unanswered" and "result" not in json.loads(other["message"])


def test_faults(spark):
    found = linked(
        spark,
        [
            (1, "c", 4, "add", '{"a":"x","c":1}', None),
            (1, "d", 6, "nope", "{}", None),
            (1, "e", 7, "add", "[1]", None),
            (1, "f", 7, "add", "bad", None),
            (1, "g", 8, "add", None, "zz"),
            (1, "h", 8, "add", GOOD, "i"),
            (1, "i", 8, "add", GOOD, "h"),
            (1, "j", 8, "add", GOOD, "i"),
            (1, "k", 9, "add", GOOD, "k"),
            (1, "m", 1, "add", GOOD, None),
            (1, "m", 2, "add", GOOD, None),
            (1, "m", 2, "add", GOOD, None),
            (None, "q", 1, "add", GOOD, None),
        ],
        [(1, "zz", 4, "o"), (None, "q", 2, "x")],
    )
    assert found[1, "c", 4]["problems"] == ["missing b", "type of a", "unknown c"]
    states = {(k[1], k[2]): r["status"] for k, r in found.items()}
    assert states == {
        ("c", 4): "invalid", ("d", 6): "unknown", ("e", 7): "invalid", ("f", 7): "invalid",
        ("g", 8): "invalid", ("h", 8): "cycle", ("i", 8): "cycle", ("j", 8): "cycle", ("k", 9): "cycle",
        ("m", 1): "unanswered", ("m", 2): "duplicate", ("q", 1): "unnamed", ("q", None): "orphan",
        ("zz", None): "orphan",
    }


def test_every_result_has_a_row(spark):
    calls = [(1, "a", 2, "add", GOOD, None), (1, "b", 0, "add", GOOD, None), (1, "n", None, "add", GOOD, None)]
    results = [
        (1, "a", 1, "before"), (1, "a", None, "no turn"), (1, "a", 3, "valid"), (1, "a", 3, "valid too"),
        (1, "a", 3, "valid too"), (1, "a", 5, None), (1, "b", 1, "x"), (1, "b", 1, "y"), (1, "n", 4, "?"),
        (None, "a", 3, "p"), (None, "a", 3, "q"), (None, None, 4, "r"), (2, None, None, "s"), (2, None, None, "t"),
    ]
    found = chat.link_calls(
        spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS
    ).collect()
    rows = Counter((r["conv_id"], r["call_id"], r["call_turn"], r["result_turn"], r["status"]) for r in found)
    assert rows == Counter(
        {
            (1, "a", 2, 3, "linked"): 1, (1, "b", 0, 1, "linked"): 1, (1, "n", None, None, "unanswered"): 1,
            (1, "a", None, 1, "early"): 1, (1, "a", None, None, "early"): 1, (1, "n", None, 4, "early"): 1,
            (1, "a", None, 3, "duplicate"): 1, (1, "a", None, 5, "duplicate"): 1,
            (1, "b", None, 1, "duplicate"): 1, (None, "a", None, 3, "orphan"): 2,
            (None, None, None, 4, "orphan"): 1, (2, None, None, None, "orphan"): 2,
        }
    )
    (a,) = [r for r in found if r["call_id"] == "a" and r["status"] == "linked"]
    assert json.loads(a["message"])["result"] == "valid"


def test_turns_with_null_keys_stay(spark):
    turns = [(None, 1, "assistant", "x"), (None, 1, "assistant", "y"), (5, None, "assistant", "x"),
             (5, None, "assistant", "z"), (6, 0, "user", "q"), (6, 1, "assistant", "x"), (6, 1, "assistant", "y")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = chat.link_calls(*chat.conversation_calls(table), chat.REPLY).collect()
    assert Counter(r["status"] for r in found) == {"orphan": 4, "linked": 1, "duplicate": 1}


def test_long_chain_and_empty(spark):
    calls = [(1, str(i), i, "add", GOOD, str(i - 1)) for i in range(100)]
    found = linked(spark, calls, [])
    assert sorted(r["level"] for r in found.values()) == list(range(100))
    assert linked(spark, [], []) == {}


def test_conversations_against_brute_force(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    found = chat.link_calls(*chat.conversation_calls(turns), chat.REPLY).collect()
    by = {(r["conv_id"], r["turn"]): r for r in turns.collect()}
    want = Counter()
    for (conv, turn), row in by.items():
        after = by.get((conv, turn + 1))
        if row["role"] == "user":
            answered = after is not None and after["role"] == "assistant"
            want["linked" if answered else "unanswered"] += 1
        elif row["role"] == "assistant":
            before = by.get((conv, turn - 1))
            want["orphan"] += before is None or before["role"] != "user"
    assert Counter(r["status"] for r in found) == +want
    for r in found[:200]:
        if r["message"]:
            message = json.loads(r["message"])
            assert message["arguments"]["prompt"] == by[r["conv_id"], r["call_turn"]]["text"]
            assert list(message) == sorted(message)
