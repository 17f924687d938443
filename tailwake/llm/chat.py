"""Chat formatting: tool calls linked with their results, ordered, validated and serialised.

Calls and results are joined by conversation and identifier. Which of several rows with one
identifier counts is settled by a grouped minimum. Calls are one row per identifier before a join, and
each distinct result meets at most one call, so the join never multiplies rows. A call may name the
call it builds on; its level is the number of calls before it on that chain. Levels come from pointer
doubling: each round joins a call with the one it points to, adds up the distances and points on, so a
chain of n calls takes log2(n) rounds, each written to the shared folder. A call whose chain never ends
is in a cycle or builds on one. Levels order calls topologically; no round sorts or gathers a
conversation.

Arguments are parsed as JSON and held against the function's schema: required fields, no unknown
fields, types. The canonical form has its keys sorted at every depth and no white space. Built-in
functions only.

Defined cases: null or malformed arguments, or arguments that are no object, are invalid. A function
without a schema is unknown. A null conversation or call identifier links with nothing: such a
call is unnamed, each such result an orphan. Of several
calls with one identifier the earliest turn, then the smallest text, is the call and the others are
duplicates. Of several results after their call the earliest turn, then the smallest content, is the
answer and the others are duplicates. A result that is not after its call, or where either turn is
null, is early. A call that builds on a missing call starts a chain. Repeated rows are one. Empty
tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailwake.sources.workspace import materialize

#: JSON types by the name a schema uses.
TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL"),
    "boolean": ("BOOLEAN",),
    "object": ("OBJECT",),
    "array": ("ARRAY",),
}
#: The function that conversations call: every user turn asks, the next assistant turn answers.
REPLY = {"reply": {"prompt": ("string", True), "turn": ("integer", True), "after": ("integer", False)}}


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no white space; null if it can't be parsed."""
    return F.to_json(F.try_parse_json(json))


def _fields(arguments: Column) -> Column:
    """(name, type) of each field of an object; null if it isn't one."""
    parsed = F.try_parse_json(arguments)
    fields = F.from_json(F.to_json(parsed), "map<string,variant>")
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return F.when(
        is_object,
        F.transform(
            F.map_entries(fields),
            lambda e: F.struct(
                e.key.alias("name"), F.regexp_extract(F.schema_of_variant(e.value), "^([A-Z]+)", 1).alias("type")
            ),
        ),
    )


def problems(function: Column, arguments: Column, schemas: dict) -> Column:
    """What is wrong with a call's arguments, as a sorted list; null for an unknown function."""
    fields = _fields(arguments)
    found = F.lit(None).cast("array<string>")
    for name, wanted in schemas.items():
        listed = F.when(fields.isNull(), F.array(F.lit("not an object"))).otherwise(
            F.array_sort(_faults(fields, wanted))
        )
        found = F.when(function == name, listed).otherwise(found)
    return found


def _faults(fields: Column, wanted: dict) -> Column:
    """Fields that are missing, unknown or of another type than ``wanted`` has them."""
    names = F.transform(fields, lambda f: f["name"])
    missing = F.array(
        *[
            F.when(~F.array_contains(names, key), F.lit(f"missing {key}"))
            for key, (_, required) in wanted.items()
            if required
        ]
    ).cast("array<string>")
    kinds = F.create_map(
        *[
            x
            for key, (kind, _) in wanted.items()
            for x in (F.lit(key), F.array(*[F.lit(t) for t in TYPES[kind]]))
        ]
    )

    def wrong(field: Column) -> Column:
        allowed = F.try_element_at(kinds, field["name"])
        return F.when(allowed.isNull(), F.concat(F.lit("unknown "), field["name"])).when(
            ~F.array_contains(allowed, field["type"]), F.concat(F.lit("type of "), field["name"])
        )

    return F.array_compact(F.concat(F.transform(fields, wrong), missing))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): the number of calls before it on its chain, null in a cycle.
    ``calls`` has one row per identifier and ``after``, the identifier that it builds on."""
    key = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("after"))
    starts = calls.join(known, ["conv_id", "after"], "left_anti").select(*key)
    chained = calls.join(known, ["conv_id", "after"]).select(*key, "after")
    nodes = starts.select(*key, F.lit(None).cast("string").alias("to"), F.lit(0).cast("long").alias("level"))
    nodes = nodes.unionByName(
        chained.select(*key, F.col("after").alias("to"), F.lit(1).cast("long").alias("level"))
    )
    nodes = materialize(nodes, "chains")
    bound, reach = nodes.count(), 1
    while reach <= 2 * bound and nodes.where("to is not null").limit(1).count():
        onward = nodes.select(
            "conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("level").alias("more")
        )
        moved = nodes.join(onward, ["conv_id", "to"], "left").select(
            *key, F.col("next").alias("to"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")
        )
        nodes, reach = materialize(moved, "chains"), 2 * reach
    return nodes.select(*key, F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row per distinct row of ``calls`` (conv_id, call_id, turn, function, arguments, after) and per
    distinct row of ``results`` (conv_id, call_id, turn, content) that answers none of them.

    conv_id, call_id, level, call_turn, result_turn, status, problems, and ``message``, the canonical
    JSON of the call with its result. Status: linked, invalid (arguments), unknown (function), cycle,
    duplicate (of another call, or of the result that answers it), unnamed
    (a null identifier), unanswered, early (a result not after its call), or orphan (a result without
    a call).
    """
    key = ["conv_id", "call_id"]
    calls = calls.select(
        "conv_id",
        F.col("call_id").cast("string").alias("call_id"),
        F.col("turn").cast("long").alias("turn"),
        "function",
        "arguments",
        F.col("after").cast("string").alias("after"),
    ).distinct()
    body = F.struct("turn", "function", "arguments", "after")
    first = (
        calls.where("conv_id is not null and call_id is not null")
        .groupBy(*key)
        .agg(F.min(body).alias("first"))
    )
    single = first.select(*key, "first.*")
    results = results.select(
        "conv_id",
        F.col("call_id").cast("string").alias("call_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.col("content").alias("content")).alias("reply"),
    ).distinct()
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    # Written, so that adaptive execution can split this join and those that follow.
    met = materialize(
        results.where(named)
        .join(single.select(*key, F.col("turn").alias("asked"), F.lit(True).alias("known")), key, "left")
        .select(
            *key,
            "reply",
            F.when(F.col("reply.turn") > F.col("asked"), "answer")
            .when(F.col("known"), "early")
            .otherwise("orphan")
            .alias("fixed"),
        ),
        "results",
    )
    replies = met.where("fixed = 'answer'").groupBy(*key).agg(F.min("reply").alias("reply"))
    ordered = single.select(*key, "after").join(levels(single.select(*key, "after")), key)
    chosen = (
        first.join(replies, key, "left")
        .join(ordered.select(*key, "level"), key, "left")
        .withColumn("answers", F.col("reply").isNotNull())
    )
    others = (
        calls.withColumn("body", body)
        .join(first, key, "left")
        .where("first is null or not (body <=> first)")
        .select(
            *key,
            F.col("body").alias("first"),
            F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "unnamed")
            .otherwise("duplicate")
            .alias("fixed"),
        )
    )
    surplus = (
        met.where("fixed = 'answer'")
        .join(replies.select(*key, F.col("reply").alias("best")), key)
        .where("not (reply <=> best)")
        .select(*key, "reply", F.lit("duplicate").alias("fixed"))
    )
    unlinked = met.where("fixed != 'answer'").unionByName(
        results.where(~named).select(*key, "reply", F.lit("orphan").alias("fixed"))
    )
    rows = chosen.withColumn("fixed", F.lit(None).cast("string"))
    for more in (others, surplus, unlinked):
        rows = rows.unionByName(more, allowMissingColumns=True)
    wrong = problems(F.col("first.function"), F.col("first.arguments"), schemas)
    linked = F.coalesce("answers", F.lit(False))
    rows = rows.withColumn("problems", F.when(F.col("first").isNotNull(), wrong))
    status = (
        F.when(F.col("fixed").isNotNull(), F.col("fixed"))
        .when(F.col("problems").isNull(), "unknown")
        .when(F.size("problems") > 0, "invalid")
        .when(F.col("level").isNull(), "cycle")
        .when(~linked, "unanswered")
        .otherwise("linked")
    )
    whole = F.struct(
        F.col("call_id").alias("id"),
        F.col("first.function").alias("function"),
        F.try_parse_json(F.col("first.arguments")).alias("arguments"),
        F.when(linked, F.col("reply.content")).alias("result"),
    )
    return rows.select(
        *key,
        "level",
        F.col("first.turn").alias("call_turn"),
        F.col("reply.turn").alias("result_turn"),
        status.alias("status"),
        F.coalesce("problems", F.array().cast("array<string>")).alias("problems"),
        F.when(status.isin("linked", "unanswered"), canonical(F.to_json(whole))).alias("message"),
    )


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text): a user turn calls
    ``reply`` and builds on the user turn two before it, an assistant turn answers the turn before."""
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")

    def named(turn: Column) -> Column:
        return F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))

    turn, before = F.col("turn"), named(F.col("turn") - 2)
    calls = turns.where("role = 'user'").select(
        "conv_id",
        named(turn).alias("call_id"),
        "turn",
        F.lit("reply").alias("function"),
        F.to_json(F.struct(F.col("text").alias("prompt"), "turn")).alias("arguments"),
        before.alias("after"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", named(turn - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results
