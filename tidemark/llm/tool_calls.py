"""Chat formatting with tool calls: link, order, validate and write canonical JSON.

**Input.** One row per turn (``conv_id``, ``turn``, ``role``, ``text``). A turn whose text is a JSON object may carry, by role: ``assistant``:
``tool_calls``, a list of ``{id, name, arguments, depends_on}``; ``tool``: ``tool_call_id`` and ``content``; ``system``: ``tools``, a list of
``{name, parameters: {required, properties: {key: {type}}}}``. All other turns are plain messages.

**Result.** One row per message, call and result. What a turn with calls says besides (its ``content`` and any other key that is not null) is a message too, part
0, with the calls behind it; unknown keys of turns, calls and results stay in the JSON. Columns: ``conv_id, turn, part`` (place within the turn), ``place, depth`` (see below), ``kind``,
``call_id``, ``status`` and ``message`` (JSON with sorted keys and without blanks). Results meet calls in a hash join on conversation and identifier, after calls
have been cut to the first of each identifier. Calls depend on the calls that they name, results on their call. In topological order an item stands
at its own turn or at the latest place of what it depends on, whichever is later, and behind that by ``depth``; sorting by ``conv_id, place, depth,
turn, part`` gives the order. It is found in rounds: items all of whose dependencies are placed are placed.

**Status.** Calls: ``ok``, ``invalid`` (a required argument missing, one of another type, or arguments that are no object), ``unknown_tool`` (the conversation
declares tools, but not this one), ``duplicate`` (not the first of its identifier), ``cycle``; then ``no_result`` if otherwise ok. Results: ``ok``, ``unlinked`` or
``cycle``. Dependencies on unknown identifiers do not count.

Only DataFrame functions are used; no conversation is gathered into one row or task.

**Cases.** A null text is a message without content, a null role one without role; invalid JSON is plain text; repeated rows repeat. Null
conversations have only plain messages that link with nothing. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.scratch import written

#: JSON schema types and how Spark names the types of JSON values (fixed values).
_TYPES = {
    "string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$", "object": "^OBJECT.*", "array": "^ARRAY.*", "null": "^VOID$",
}
_KEY = ["conv_id", "call_id"]


def _at(variant: str, path: str, kind: str) -> Column:
    return F.try_variant_get(F.col(variant), path, kind)


def _valid(arguments: Column, required: Column, kinds: Column) -> Column:
    """Required keys are present, and declared ones have their types."""
    given = F.try_variant_get(arguments, "$", "map<string,variant>")
    have = F.coalesce(F.map_keys(given), F.array().cast("array<string>"))

    def fits(k: Column, v: Column) -> Column:
        want = F.try_element_at(kinds, k)
        pattern = F.coalesce(*(F.when(want == t, p) for t, p in _TYPES.items()), F.lit(".*"))
        return F.coalesce(F.regexp(F.schema_of_variant(v), pattern), F.lit(True))

    typed = F.size(F.map_filter(given, lambda k, v: ~fits(k, v))) == 0
    needed = F.size(F.array_except(F.coalesce(required, F.array().cast("array<string>")), have)) == 0
    return given.isNotNull() & needed & typed


def _canonical(keys: Column, role: str) -> Column:
    """JSON of the keys and values in ``keys`` (a map) and the role of the turn."""
    names = F.array_sort(F.array_union(F.map_keys(keys), F.array(F.lit("role"))))
    value = lambda k: F.when(k == "role", F.lit(role).cast("variant")).otherwise(F.try_element_at(keys, k))
    return F.to_json(F.map_from_arrays(names, F.transform(names, value)))


def linked_messages(turns: DataFrame) -> DataFrame:
    rows = turns.select("conv_id", "turn", "role", "text")
    js = F.when(F.ltrim("text").startswith("{") & F.col("role").isin("assistant", "tool", "system") & F.col("conv_id").isNotNull(), F.try_parse_json("text"))
    rows = rows.withColumn("js", js)
    calls_of, result_of = _at("js", "$.tool_calls", "array<variant>"), _at("js", "$.tool_call_id", "string")
    rows = rows.withColumn("kind", F.when((F.col("role") == "assistant") & (F.size(calls_of) > 0), "call").when((F.col("role") == "tool") & result_of.isNotNull(), "result").otherwise("message"))
    said = lambda **k: F.to_json(F.struct(*(v.alias(n) for n, v in sorted(k.items()))))
    same = ["conv_id", "turn", "part", "place", "depth", "kind", "call_id", "status", "message"]
    plain = rows.filter("kind = 'message'").select(
        "conv_id", "turn", F.lit(0).alias("part"), F.col("turn").alias("place"), F.lit(0).alias("depth"), "kind", F.lit(None).cast("string").alias("call_id"),
        F.lit("ok").alias("status"), said(role=F.col("role"), content=F.col("text")).alias("message"),
    )

    # What a turn with calls says besides.
    keys = _at("js", "$", "map<string,variant>")
    rest = F.map_filter(keys, lambda k, _: ~k.isin("tool_calls", "role"))
    more = F.size(F.map_filter(rest, lambda _, v: ~F.is_variant_null(v))) > 0
    calling = rows.filter("kind = 'call'").withColumn("more", F.coalesce(more, F.lit(False)))
    plain = plain.unionByName(calling.filter("more").select(
        "conv_id", "turn", F.lit(0).alias("part"), F.col("turn").alias("place"), F.lit(0).alias("depth"), F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"), _canonical(rest, "assistant").alias("message"),
    ))

    call = calling.select("conv_id", "turn", "more", F.posexplode(_at("js", "$.tool_calls", "array<variant>")).alias("part", "c"))
    call = call.select(
        "conv_id", "turn", (F.col("part") + F.col("more").cast("int")).alias("part"), "c", _at("c", "$.id", "string").alias("call_id"), _at("c", "$.name", "string").alias("name"),
        _at("c", "$.arguments", "variant").alias("arguments"), _at("c", "$.depends_on", "array<string>").alias("needs"),
    )
    result = rows.filter("kind = 'result'").select(
        "conv_id", "turn", F.lit(0).alias("part"), _at("js", "$.tool_call_id", "string").alias("call_id"), _canonical(keys, "tool").alias("message")
    )
    # One row per conversation and tool: the last declaration holds.
    tool = rows.filter("role = 'system' AND js IS NOT NULL").select("conv_id", "turn", F.posexplode(_at("js", "$.tools", "array<variant>")).alias("at", "t"))
    tool = tool.select(
        "conv_id", "turn", "at", _at("t", "$.name", "string").alias("name"), _at("t", "$.parameters.required", "array<string>").alias("required"),
        F.transform_values(_at("t", "$.parameters.properties", "map<string,variant>"), lambda _, v: F.try_variant_get(v, "$.type", "string")).alias("kinds"),
    )
    tool = tool.groupBy("conv_id", "name").agg(F.max_by(F.struct("required", "kinds"), F.struct("turn", "at")).alias("schema"))
    declared = tool.groupBy("conv_id").agg(F.lit(True).alias("declared"))

    # Calls: the first of an identifier is the one that others mean.
    first = call.filter("call_id IS NOT NULL").groupBy(*_KEY).agg(F.min(F.struct("turn", "part")).alias("f"))
    answered = result.groupBy(*_KEY).agg(F.lit(True).alias("answered"))
    call = call.join(first, _KEY, "left").join(answered, _KEY, "left").join(tool, ["conv_id", "name"], "left").join(declared, "conv_id", "left")
    repeated = F.col("call_id").isNotNull() & (F.struct("turn", "part") != F.col("f"))
    fine = _valid(F.col("arguments"), F.col("schema.required"), F.col("schema.kinds"))
    status = (
        F.when(repeated, "duplicate").when(F.col("declared") & F.col("schema").isNull(), "unknown_tool").when(~fine, "invalid")
        .when(F.col("answered").isNull(), "no_result").otherwise("ok")
    )
    message = said(role=F.lit("assistant"), tool_call=F.col("c"))
    call = call.select("conv_id", "turn", "part", F.lit("call").alias("kind"), "call_id", status.alias("status"), message.alias("message"), "needs", (~repeated).alias("own"))
    result = result.join(first.select(*_KEY, F.lit(True).alias("known")), _KEY, "left").select(
        "conv_id", "turn", "part", F.lit("result").alias("kind"), "call_id", F.when(F.col("known"), "ok").otherwise("unlinked").alias("status"),
        "message",
        F.array("call_id").alias("needs"), F.lit(False).alias("own"),
    )
    items = written(call.unionByName(result).withColumn("item", F.monotonically_increasing_id()))
    return plain.select(*same).unionByName(_ordered(items).select(*same))


def _ordered(items: DataFrame) -> DataFrame:
    """``items`` with ``place`` and ``depth``, found round by round; each round is written, so plans stay small."""
    named = items.filter("own AND call_id IS NOT NULL").select("conv_id", F.col("call_id").alias("need"), F.col("item").alias("on"))
    edges = items.select("conv_id", "item", F.explode(F.array_distinct("needs")).alias("need")).join(named, ["conv_id", "need"]).select("item", "on")
    edges = written(edges)
    waiting = edges.select("item").distinct()
    placed = items.join(waiting, "item", "left_anti").select("item", F.col("turn").alias("place"), F.lit(0).alias("depth"))
    if edges.isEmpty():
        return items.join(placed, "item")
    placed, turn = written(placed), items.select("item", "turn")
    while True:
        known = placed.select(F.col("item").alias("on"), "place", "depth")
        ready = edges.join(placed.select("item"), "item", "left_anti").join(known, "on", "left").groupBy("item").agg(
            F.max("place").alias("p"), F.max("depth").alias("d"), F.bool_and(F.col("place").isNotNull()).alias("all")
        )
        ready = written(ready.filter("all").join(turn, "item").select("item", F.greatest("turn", "p").alias("place"), (F.col("d") + 1).alias("depth")))
        if ready.isEmpty():
            break
        placed = written(placed.union(ready))
    out = items.join(placed, "item", "left").withColumn("status", F.when(F.col("place").isNull(), "cycle").otherwise(F.col("status")))
    return out.withColumn("place", F.coalesce("place", "turn")).withColumn("depth", F.coalesce("depth", F.lit(0)))
