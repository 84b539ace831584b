"""Tool calls and their results: linked by identifier, put in order, checked against schemas, written as canonical JSON.

Everything is DataFrame work: joins and aggregates on (conversation, identifier), a levelled
topological sort for conversations that need one, and one projection compiled from the schemas.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborsync.staging import stage

_ANSWERED, _OPEN, _ORPHAN, _REPEATED = "linked", "unanswered", "orphan", "duplicate"

# What schema_of_variant says of the JSON types.
_TYPES = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*|FLOAT)$", "boolean": "^BOOLEAN$",
    "array": "^ARRAY.*", "object": "^OBJECT.*", "null": "^VOID$",
}


def _name(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def schema_errors(arguments: str, schema: Mapping) -> Column:
    """Sorted messages on how a JSON text column breaks an object schema; none if it holds.

    Understands properties with type (one or a list), enum, minimum, maximum, minLength and maxLength, required,
    and additionalProperties: false. Null arguments, and texts that are no JSON object or repeat a key, give one message.
    """
    value = f"try_parse_json(`{arguments}`)"
    checks: list[Column] = []
    properties = schema.get("properties", {})
    for name, rule in sorted(properties.items()):
        path = _name('$["' + name + '"]')
        kind = F.expr(f"schema_of_variant(try_variant_get({value}, {path}, 'variant'))")
        given = F.expr(f"array_contains(json_object_keys(`{arguments}`), {_name(name)})")
        text, number = (F.expr(f"try_variant_get({value}, {path}, '{to}')") for to in ("string", "double"))
        if "type" in rule:
            allowed = [rule["type"]] if isinstance(rule["type"], str) else list(rule["type"])
            pattern = "|".join(_TYPES[t] for t in allowed)
            checks.append(F.when(given & ~kind.rlike(pattern), f"{name}: not {' or '.join(allowed)}"))
        is_text, is_number = kind == "STRING", kind.rlike(_TYPES["number"])
        if "enum" in rule:
            encoded = F.expr(f"to_json(try_variant_get({value}, {path}, 'variant'))")
            allowed = [json.dumps(v, ensure_ascii=False, separators=(",", ":"), sort_keys=True) for v in rule["enum"]]
            checks.append(F.when(given & ~encoded.isin(allowed), f"{name}: not in enum"))
        for key, broken in (
            ("minLength", is_text & (F.char_length(text) < F.lit(rule.get("minLength")))),
            ("maxLength", is_text & (F.char_length(text) > F.lit(rule.get("maxLength")))),
            ("minimum", is_number & (number < F.lit(rule.get("minimum")))),
            ("maximum", is_number & (number > F.lit(rule.get("maximum")))),
        ):
            if key in rule:
                checks.append(F.when(given & broken, f"{name}: {key}"))
    keys = F.expr(f"json_object_keys(`{arguments}`)")
    for name in schema.get("required", []):
        checks.append(F.when(~F.array_contains(keys, name), f"{name}: missing"))
    found = F.array(*checks) if checks else F.array().cast("array<string>")
    if schema.get("additionalProperties") is False:
        known = F.array(*[F.lit(p) for p in properties]) if properties else F.array().cast("array<string>")
        found = F.concat(found, F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(": not allowed"))))
    is_object = F.coalesce(F.expr(f"schema_of_variant({value})").rlike("^OBJECT"), F.lit(False))
    return F.when(~is_object, F.array(F.lit("arguments: not a JSON object"))).otherwise(
        F.array_sort(F.filter(found, lambda e: e.isNotNull())))


def _check(tool: Column, arguments: str, schemas: Mapping[str, Mapping]) -> Column:
    """Errors by the schema of the tool; a tool without one is itself an error."""
    unknown = F.array(F.lit("tool: unknown"))
    return reduce(lambda rest, name: F.when(tool == name, schema_errors(arguments, schemas[name])).otherwise(rest), sorted(schemas), unknown)


# No way is longer; ways in circles stop growing here.
LONGEST_WAY = 1 << 40


def topological_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conversation, key, level, cyclic) for ``nodes`` (conversation, key, position), which must be unique.

    ``edges`` (conversation, key, needs): a call and one it needs. Where every need comes earlier in
    position, position is already a topological order and the level is 0. In other conversations the
    level is the number of calls on the longest way of needs. A call whose needs are all settled is
    settled; one with a single open need hands its way on to what that one needs, so that ways
    double in each round and a chain of calls takes as many rounds as its length has digits to base
    two. What is on no way to a settled call is cyclic, or needs something that is; its level is null.
    """
    places = nodes.select("conversation", F.col("key").alias("needs"), F.col("position").alias("needed_position"))
    known = edges.join(places, ["conversation", "needs"]).join(nodes, ["conversation", "key"])
    late = known.where(~(F.col("needed_position") < F.col("position")) | F.col("position").isNull() | F.col("needed_position").isNull())
    disordered = stage(late.select("conversation").distinct(), "disordered")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    settled = nodes.join(disordered, "conversation", "left_anti").select("conversation", "key", zero.alias("level"))
    # A way from a call to an open need: ``far`` calls on, the last of which may still need more.
    ways = stage(known.join(disordered, "conversation", "left_semi").select("conversation", "key", "needs", one.alias("far")), "ways")
    at = ["conversation", "key"]
    left = stage(nodes.join(disordered, "conversation", "left_semi").select(*at, zero.alias("level")), "open")
    circles = stage(left.select(*at).limit(0), "circles")
    idle, limit, latest = 0, 2, circles
    while not left.isEmpty():
        free = stage(left.join(ways.select(*at).distinct(), at, "left_anti"), "free")
        settled = settled.unionByName(free)
        # A way back to its own call is a circle, and so is what needs a call of one.
        on = ways.where("key = needs").select(*at).unionByName(
            ways.join(latest.select("conversation", F.col("key").alias("needs")), ["conversation", "needs"], "left_semi").select(*at))
        latest = stage(on.distinct(), "circles")
        circles = circles.unionByName(latest)
        idle = idle + 1 if free.isEmpty() and latest.isEmpty() else 0
        if idle == 0:
            # Circles of calls with several needs are no ways of one call; they are what stays while all ways have doubled so often.
            limit = max(left.count(), 1).bit_length() + 1
        if idle > limit:
            break
        done = free.select("conversation", F.col("key").alias("needs"), F.col("level").alias("reached"))
        met = ways.join(latest, at, "left_anti").join(done, ["conversation", "needs"], "left")
        gained = met.where("reached is not null").groupBy(*at).agg(F.max(F.col("reached") + F.col("far")).alias("gained"))
        rest = stage(met.where("reached is null").select(*at, "needs", "far"), "ways")
        left = stage(left.join(free.select(*at).unionByName(latest), at, "left_anti").join(gained, at, "left").select(
            *at, F.greatest("level", F.coalesce("gained", zero)).alias("level")), "open")
        # Only a call that waits for one other hands on, and what that one has gained so far goes with it.
        single = rest.groupBy(*at).agg(F.count("*").alias("n"), F.max("needs").alias("then"), F.max("far").alias("further")).where("n = 1")
        onward = single.join(left, at).select("conversation", F.col("key").alias("needs"), "then", "further", F.col("level").alias("passed"))
        jumped = stage(rest.join(onward, ["conversation", "needs"], "left"), "jumps")
        passed = jumped.where("then is not null").groupBy(*at).agg(F.max(F.col("far") + F.col("passed")).alias("gained"))
        left = stage(left.join(passed, at, "left").select(*at, F.greatest("level", F.coalesce("gained", zero)).alias("level")), "open")
        far = F.least(F.col("far") + F.coalesce("further", zero), F.lit(LONGEST_WAY).cast("bigint"))
        ways = stage(
            jumped.select(*at, F.coalesce("then", "needs").alias("needs"), far.alias("far")).groupBy(*at, "needs").agg(F.max("far").alias("far")), "ways")
    circles = circles.unionByName(left.select(*at)).distinct()
    return settled.select(*at, "level", F.lit(False).alias("cyclic")).unionByName(
        circles.select(*at, F.lit(None).cast("bigint").alias("level"), F.lit(True).alias("cyclic")))


def _steps(calls: DataFrame) -> DataFrame:
    """Add step: 1, 2, ... in each conversation by (cyclic, level, position, key).

    One sort by range cuts long conversations into pieces; a piece counts its own rows, and only the
    conversation that goes on from the piece before is shifted.
    """
    order = ["conversation", "cyclic", "level", "position", "key"]
    pieces = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = calls.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
    # Where a row lies is a fact of this one shuffle, so it is written down first.
    placed = stage(dealt.withColumn("_at", F.monotonically_increasing_id()), "ordered").withColumns({
        "_piece": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    runs = placed.groupBy("conversation", "_piece").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    before = Window.partitionBy("conversation").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = runs.select(
        "conversation", "_piece", (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return placed.join(shifts, ["conversation", "_piece"]).withColumn("step", F.col("_at") + F.col("_shift")).drop("_at", "_piece", "_shift")


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """One row per call and per result: conversation, position, kind, id, status, step, n_errors, errors, json.

    ``calls``: conversation, id, position, tool, arguments (JSON text), needs (ids of calls it builds
    on); ``results``: conversation, id, position, content. Within a conversation the first call and
    the first result of an id, by position, are a pair. status is ``linked`` for both, ``unanswered``
    for a call without a result, ``orphan`` for a result without a call, ``duplicate`` for later rows
    of an id. Rows with a null id are never linked. step numbers first calls in topological order,
    ties by position; a result has its call's step; duplicates and orphans have none. errors holds
    schema violations, ``needs <id>: missing`` and ``needs: cyclic``. json is the message with sorted
    keys and no spaces, absent parts left out; arguments that are not JSON stay a string. A null
    conversation is a conversation of its own; repeated identical rows get identical answers; of rows
    that share id and position the least by its other columns comes first. Further columns play no part.
    """
    name = lambda df: F.coalesce(F.col("conversation").cast("string"), F.lit("\0null"))
    key = F.coalesce(F.col("id"), F.concat(F.lit("\0"), F.coalesce(F.col("position").cast("string"), F.lit(""))))
    told = lambda df, kind: df.withColumns({"_conversation": name(df), "_key": F.concat(key, F.when(F.col("id").isNull(), kind).otherwise(""))})
    asked = told(calls.select("conversation", "id", "position", "tool", "arguments", "needs"), "\0call")
    answered = told(results.select("conversation", "id", "position", "content"), "\0result")
    by = ["_conversation", "_key"]
    first_calls = asked.groupBy(*by).agg(F.min(F.struct("position", "tool", "arguments", "needs")).alias("call")).withColumn("needs", F.col("call.needs"))
    first_results = answered.groupBy(*by).agg(F.min(F.struct("position", "content")).alias("result"))
    links = stage(first_calls.join(first_results, by, "full"), "links")

    nodes = links.where("call is not null").select(
        F.col("_conversation").alias("conversation"), F.col("_key").alias("key"), F.col("call.position").alias("position"))
    edges = links.where("call is not null").select(
        F.col("_conversation").alias("conversation"), F.col("_key").alias("key"), F.explode(F.array_distinct("needs")).alias("needs"),
    ).where("needs is not null")
    absent = edges.join(
        nodes.select("conversation", F.col("key").alias("needs")), ["conversation", "needs"], "left_anti"
    ).groupBy("conversation", "key").agg(F.array_sort(F.collect_set(F.concat(F.lit("needs "), "needs", F.lit(": missing")))).alias("absent"))
    levels = topological_levels(nodes, edges)
    steps = _steps(nodes.join(levels, ["conversation", "key"])).select(
        F.col("conversation").alias("_conversation"), F.col("key").alias("_key"), "step", "cyclic")
    about = links.join(steps, by, "left").join(
        absent.select(F.col("conversation").alias("_conversation"), F.col("key").alias("_key"), "absent"), by, "left"
    ).select(*by, "call", "result", "step", "cyclic", "absent")

    none = F.array().cast("array<string>")
    checked = asked.withColumn("_errors", _check(F.col("tool"), "arguments", schemas)).join(about, by)
    is_first = F.struct("position", "tool", "arguments", "needs").eqNullSafe(F.col("call"))
    call_status = F.when(~is_first, _REPEATED).when(F.col("result").isNotNull(), _ANSWERED).otherwise(_OPEN)
    call_errors = F.concat(
        "_errors", F.when(is_first, F.coalesce("absent", none)).otherwise(none),
        F.when(is_first & F.col("cyclic"), F.array(F.lit("needs: cyclic"))).otherwise(none))
    parsed = F.try_parse_json("arguments")
    body = lambda arguments: F.to_json(F.struct(
        arguments.alias("arguments"), F.col("id"), F.lit("call").alias("kind"), F.array_sort("needs").alias("needs"), F.col("tool").alias("tool")))
    call_rows = checked.select(
        "conversation", "position", F.lit("call").alias("kind"), "id", call_status.alias("status"),
        F.when(is_first, F.col("step")).alias("step"), call_errors.alias("errors"),
        F.when(parsed.isNotNull(), body(parsed)).otherwise(body(F.col("arguments"))).alias("json"))
    matched = answered.join(about, by)
    is_first = F.struct("position", "content").eqNullSafe(F.col("result"))
    result_status = F.when(~is_first, _REPEATED).when(F.col("call").isNotNull(), _ANSWERED).otherwise(_ORPHAN)
    result_rows = matched.select(
        "conversation", "position", F.lit("result").alias("kind"), "id", result_status.alias("status"),
        F.when(is_first, F.col("step")).alias("step"), none.alias("errors"),
        F.to_json(F.struct("content", "id", F.lit("result").alias("kind"))).alias("json"))
    rows = call_rows.union(result_rows)
    return rows.withColumn("n_errors", F.size("errors").cast("bigint"))
