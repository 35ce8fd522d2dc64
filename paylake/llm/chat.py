"""Tool calls of conversations linked with their results, in order, checked and serialised.

All of it is DataFrame expressions. Calls and results are nodes with a place of their own. Equal rows are rolled up to
one with a number, and the first call and the first result of each identifier meet by shuffled hash joins of unique
keys, so a repeated identifier multiplies nothing. A conversation is put in a topological order: a result
stands behind its call even if it was written before it, a call whose arguments name another call of the conversation stands
behind that call's result, and else the written order holds. Rounds over the calls that depend on others
settle these first; calls in a cycle never settle, keep their written position and are reported. Places are
counted in two steps, inside stretches of a conversation and over the stretches, so that a very long conversation is
spread over tasks. Arguments are checked against a schema of the tool and written as canonical JSON: sorted keys,
no white space.

Defined results: of calls, or results, that repeat an identifier, the first written is linked, of
those the least text; every further copy has a row and a place with status ``duplicate``, and is checked and written
too. A call without a result is ``unanswered``, a result without a call an ``orphan``. What has no conversation or no
identifier is ``unidentified`` and has no place. Arguments that are no JSON object have
the error ``not an object`` and null in the JSON.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import pick, stored

#: Positions counted together in one group.
STRETCH = 1024

#: For each tool its arguments: type, whether required, least and greatest value (for text: length).
Schema = Mapping[str, Mapping[str, tuple[str, bool, int | None, int | None]]]

#: The tools that turns of a plain conversation stand for.
TURN_SCHEMA: Schema = {
    "reply": {"text": ("string", True, 1, 400), "turn": ("integer", True, 0, None)},
    "configure": {"text": ("string", True, 1, 4000), "turn": ("integer", True, 0, 0)},
    "note": {"text": ("string", False, None, None), "turn": ("integer", True, 0, None)},
}


def calls_of_messages(messages: DataFrame) -> DataFrame:
    """Calls in assistant messages whose text is JSON with ``tool_calls`` of id, name and arguments."""
    found = F.from_json("text", "tool_calls array<struct<id string, name string, arguments string>>")["tool_calls"]
    rows = pick(messages, "conv_id", "turn", "role", "text").where("role = 'assistant'")
    each = rows.select("conv_id", F.col("turn").alias("position"), F.explode(found).alias("call"))
    return each.select("conv_id", "call.id", "position", "call.name", "call.arguments")


def results_of_messages(messages: DataFrame) -> DataFrame:
    """Results in tool messages whose text is JSON with ``tool_call_id`` and ``content``."""
    rows = pick(messages, "conv_id", "turn", "role", "text").where("role = 'tool'")
    found = F.from_json("text", "tool_call_id string, content string")
    return rows.select("conv_id", found["tool_call_id"].alias("id"), F.col("turn").alias("position"), found["content"].alias("content"))


def calls_of_turns(messages: DataFrame) -> DataFrame:
    """The turns of plain conversations as calls: a user's turn asks for a reply."""
    rows = pick(messages, "conv_id", "turn", "role", "text").where("role is null or role <> 'assistant'")
    name = F.when(F.col("role") == "user", "reply").when(F.col("role") == "system", "configure").otherwise("note")
    arguments = F.to_json(F.struct("text", "turn"))
    return rows.select(
        "conv_id",
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.col("turn").alias("position"),
        name.alias("name"),
        arguments.alias("arguments"),
    ).withColumn("id", F.when(F.col("position").isNotNull(), F.col("id")))


def results_of_turns(messages: DataFrame) -> DataFrame:
    """An assistant's turn as the result of the turn before it."""
    rows = pick(messages, "conv_id", "turn", "role", "text").where("role = 'assistant'")
    identifier = F.when(F.col("turn").isNotNull(), F.concat_ws(":", "conv_id", (F.col("turn") - 1).cast("string")))
    return rows.select("conv_id", identifier.alias("id"), F.col("turn").alias("position"), F.col("text").alias("content"))


def calls_of_table(messages: DataFrame) -> DataFrame:
    """Calls that messages hold as JSON, and the turns of plain conversations that stand for calls."""
    rows = pick(messages, "conv_id", "turn", "role", "text")
    plain = rows.where(~F.coalesce(_is_result(), F.lit(False)))
    return calls_of_messages(rows).unionByName(calls_of_turns(plain))


def results_of_table(messages: DataFrame) -> DataFrame:
    """Results that messages hold as JSON, and the turns of plain conversations that stand for results."""
    rows = pick(messages, "conv_id", "turn", "role", "text")
    plain = rows.where(~F.coalesce(_has_calls(), F.lit(False)))
    return results_of_messages(rows.where(_is_result())).unionByName(results_of_turns(plain))


def _has_calls() -> Column:
    return (F.col("role") == "assistant") & F.get_json_object("text", "$.tool_calls").isNotNull()


def _is_result() -> Column:
    return (F.col("role") == "tool") & F.get_json_object("text", "$.tool_call_id").isNotNull()


def errors(arguments: Column, name: Column, schema: Schema) -> Column:
    """What is wrong with arguments, as an array of texts."""
    parsed = F.try_parse_json(arguments)
    keys = F.json_object_keys(arguments)
    by_tool = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, fields in schema.items():
        found = []
        for field, (kind, required, low, high) in fields.items():
            value = F.try_variant_get(parsed, f"$.{field}", "variant")
            present = value.isNotNull() & ~F.is_variant_null(value)
            is_kind = F.schema_of_variant(value).isin(*{"string": ("STRING",), "integer": ("BIGINT",)}[kind])
            size = F.length(F.try_variant_get(parsed, f"$.{field}", "string")) if kind == "string" else F.try_variant_get(parsed, f"$.{field}", "bigint")
            outside = F.lit(False)
            if low is not None:
                outside = outside | (size < low)
            if high is not None:
                outside = outside | (size > high)
            found.append(
                F.when(~F.coalesce(present, F.lit(False)), F.lit(f"missing {field}" if required else None))
                .when(~is_kind, F.lit(f"type {field}"))
                .when(outside, F.lit(f"range {field}"))
            )
        unknown = F.transform(F.array_sort(F.array_except(keys, F.array(*map(F.lit, fields)))), lambda k: F.concat(F.lit("unknown "), k))
        of_tool = F.concat(F.array_compact(F.array(*found)), unknown)
        by_tool = F.when(name == tool, of_tool).otherwise(by_tool)
    return F.when(keys.isNull(), F.array(F.lit("not an object"))).otherwise(by_tool)


def _needs(calls: DataFrame) -> DataFrame:
    """(conv_id, id, needs): calls that name another call, or themselves, in an argument. Unique identifiers.

    Only hashes of arguments are shuffled.
    """
    values = F.explode(F.map_values(F.from_json("body", "map<string,string>")))
    named = calls.select("conv_id", "id", values.alias("value")).where("value is not null")
    named = named.select("conv_id", "id", F.xxhash64("value").alias("hash"), F.crc32(F.col("value").cast("binary")).alias("check"))
    known = calls.select(
        "conv_id", F.col("id").alias("needs"), F.xxhash64("id").alias("hash"), F.crc32(F.col("id").cast("binary")).alias("check")
    )
    return named.join(known.hint("shuffle_hash"), ["conv_id", "hash", "check"]).select("conv_id", "id", "needs").distinct()


def _settled(firsts: DataFrame) -> DataFrame:
    """For calls that depend on others, or that others depend on: ``from_at`` and ``level`` in the order, ``cycle``.

    ``firsts`` has conv_id, id and the first call ``c`` and result ``r`` of each identifier. A round settles all calls whose
    needs are settled; there are as many rounds as the longest chain has calls.
    """
    key = ["conv_id", "id"]
    calls = firsts.where("c is not null").select(*key, F.col("c.position").alias("at"), F.col("r.position").alias("answered"), F.col("c.body").alias("body"))
    edges = stored(_needs(calls), "needs")
    nodes = edges.select(*key).union(edges.select("conv_id", "needs")).distinct()
    calls = stored(calls.drop("body").join(nodes, key, "left_semi"), "calls")
    wanted = edges.groupBy(*key).agg(F.count("*").alias("n"))
    done = calls.join(wanted, key, "left_anti").select(*key, "at", "answered", F.lit(0).alias("level"))
    done = stored(done, "settled")
    while True:
        ready = done.select("conv_id", F.col("id").alias("needs"), F.greatest("at", "answered").alias("behind"), "level")
        met = edges.join(done.select(*key), key, "left_anti").join(ready, ["conv_id", "needs"]).groupBy(*key)
        met = met.agg(F.count("*").alias("n"), F.max("behind").alias("behind"), (F.max("level") + 1).alias("level"))
        now = met.join(wanted, [*key, "n"], "left_semi").join(calls, key)
        now = stored(now.select(*key, F.greatest("at", "behind").alias("at"), "answered", "level"), "settled")
        if now.isEmpty():
            break
        done = done.union(now)
    rest = calls.join(done.select(*key), key, "left_anti").select(*key, "at", F.lit(0).alias("level"), F.lit(True).alias("cycle"))
    return done.select(*key, "at", "level", F.lit(False).alias("cycle")).union(rest).withColumnRenamed("at", "from_at")


def sequence(calls: DataFrame, results: DataFrame, schema: Schema) -> DataFrame:
    """One row for each call and for each result, also those that repeat an identifier, in topological order.

    A result stands at its own position or, if that is not behind its call's, behind the calls there; a call
    stands behind the results of the calls that its arguments name.
    Columns of the result: conv_id, id, kind (call or result), name, status (of further copies
    ``duplicate``), position (as written), place (from 0), partner_place (of the linked
    result or call), valid, errors, json.
    """
    sides = [
        calls.select("conv_id", "id", F.lit(0).alias("side"), "position", "name", F.col("arguments").alias("body")),
        results.select("conv_id", "id", F.lit(1).alias("side"), "position", F.lit(None).cast("string").alias("name"), F.col("content").alias("body")),
    ]
    rows = sides[0].unionByName(sides[1])
    known = F.col("conv_id").isNotNull() & F.col("id").isNotNull()
    # Equal rows are numbered from their count, so that no window has all copies of an identifier.
    equal = rows.where(known).groupBy(*rows.columns).agg(F.count("*").alias("n"))
    one = F.struct("position", "name", "body")
    firsts = equal.groupBy("conv_id", "id").agg(
        *(F.min(F.when(F.col("side") == side, one)).alias(c) for side, c in ((0, "c"), (1, "r")))
    )
    firsts = stored(firsts, "firsts")
    joined = equal.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).join(firsts.hint("shuffle_hash"), ["conv_id", "id"])
    joined = joined.join(_settled(firsts).hint("shuffle_hash"), ["conv_id", "id"], "left")
    is_first = (F.col("copy") == 1) & F.when(F.col("side") == 0, one.eqNullSafe(F.col("c"))).otherwise(one.eqNullSafe(F.col("r")))
    both = F.col("c").isNotNull() & F.col("r").isNotNull()
    status = F.when(~is_first, "duplicate").when(both, "linked").otherwise(F.when(F.col("side") == 0, "unanswered").otherwise("orphan"))
    own = F.when(is_first, F.coalesce("from_at", "position")).otherwise(F.col("position"))
    at = F.when(F.col("side") == 0, own).otherwise(F.greatest("position", "c.position", "from_at"))
    cycle = (F.col("side") == 0) & is_first & F.coalesce("cycle", F.lit(False))
    level = F.when(is_first | (F.col("side") == 1), F.coalesce("level", F.lit(0))).otherwise(0)
    nodes = joined.select(*rows.columns, "copy", status.alias("status"), at.alias("at"), level.alias("level"), cycle.alias("cycle"))
    nodes = nodes.withColumn("stretch", F.floor(F.col("at") / STRETCH))

    sizes = nodes.groupBy("conv_id", "stretch").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        F.col("conv_id").alias("b_conv"), F.col("stretch").alias("b_stretch"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    order = Window.partitionBy("conv_id", "stretch").orderBy("at", "level", "side", "id", "position", "name", "body", "copy")
    same = (F.col("conv_id") == F.col("b_conv")) & F.col("stretch").eqNullSafe(F.col("b_stretch"))
    placed = nodes.withColumn("inside", F.row_number().over(order) - 1).join(before.hint("shuffle_hash"), same)
    placed = placed.select(*rows.columns, "status", "cycle", (F.col("before") + F.col("inside")).alias("place"))
    partners = placed.where("status = 'linked'").select("conv_id", "id", (1 - F.col("side")).alias("side"), "status", F.col("place").alias("partner_place"))
    placed = placed.join(partners.hint("shuffle_hash"), ["conv_id", "id", "side", "status"], "left")
    placed = placed.select(*rows.columns, "status", "cycle", "place", "partner_place")
    none = F.lit(None).cast("long")
    unnamed = rows.where(~known).select(*rows.columns, F.lit("unidentified").alias("status"), F.lit(False).alias("cycle"), none.alias("place"), none.alias("partner_place"))

    every = placed.unionByName(unnamed)
    is_call = F.col("side") == 0
    every = every.withColumn("wrong", F.when(is_call, errors(F.col("body"), F.col("name"), schema)).otherwise(F.array().cast("array<string>")))
    sound = F.when(~F.array_contains("wrong", "not an object"), F.try_parse_json("body"))
    every = every.withColumn("wrong", F.when(F.col("cycle"), F.array_append("wrong", F.lit("cycle"))).otherwise(F.col("wrong")))
    keep_nulls = {"ignoreNullFields": "false"}
    call = F.to_json(F.struct(sound.alias("arguments"), "id", "name"), keep_nulls)
    result = F.to_json(F.struct(F.col("body").alias("content"), F.col("id").alias("tool_call_id")), keep_nulls)
    return every.select(
        "conv_id",
        "id",
        F.when(is_call, "call").otherwise("result").alias("kind"),
        "name",
        "status",
        "position",
        "place",
        "partner_place",
        (F.size("wrong") == 0).alias("valid"),
        F.array_join("wrong", "; ").alias("errors"),
        F.when(is_call, call).otherwise(result).alias("json"),
    )


#: The rows of the query over plain conversations, in SQL. The limits are those of TURN_SCHEMA.
TURNS_SQL = """
WITH m AS (SELECT conv_id, turn, role, text FROM conversations),
nodes AS (
  SELECT conv_id, CASE WHEN turn IS NOT NULL THEN concat_ws(':', conv_id, turn) END AS id, 0 AS side, turn AS position,
         CASE role WHEN 'user' THEN 'reply' WHEN 'system' THEN 'configure' ELSE 'note' END AS name,
         '{' || concat_ws(',', CASE WHEN text IS NOT NULL THEN '"text":' || CAST(to_json(text) AS VARCHAR) END,
                          CASE WHEN turn IS NOT NULL THEN '"turn":' || turn END) || '}' AS body, text
  FROM m WHERE role IS DISTINCT FROM 'assistant'
  UNION ALL
  SELECT conv_id, CASE WHEN turn IS NOT NULL THEN concat_ws(':', conv_id, turn - 1) END, 1, turn, NULL, text, NULL
  FROM m WHERE role = 'assistant'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, id, side ORDER BY position, name NULLS FIRST, body NULLS FIRST) AS nth,
         min(CASE WHEN side = 0 THEN position END) OVER (PARTITION BY conv_id, id) AS called,
         count(DISTINCT side) OVER (PARTITION BY conv_id, id) AS sides
  FROM nodes WHERE conv_id IS NOT NULL AND id IS NOT NULL),
placed AS (
  SELECT conv_id, id, side, position, name, body, text,
         CASE WHEN nth > 1 THEN 'duplicate' WHEN sides = 2 THEN 'linked' WHEN side = 0 THEN 'unanswered' ELSE 'orphan' END AS status,
         row_number() OVER (PARTITION BY conv_id ORDER BY
           CASE WHEN side = 0 THEN position ELSE greatest(position, coalesce(called, position)) END,
           side, id, position, name NULLS FIRST, body NULLS FIRST) - 1 AS place
  FROM numbered),
every AS (
  SELECT *, CASE WHEN status = 'linked' THEN sum(place) FILTER (status = 'linked') OVER (PARTITION BY conv_id, id) - place END
    AS partner_place FROM placed
  UNION ALL
  SELECT conv_id, id, side, position, name, body, text, 'unidentified', NULL, NULL FROM nodes WHERE conv_id IS NULL OR id IS NULL),
checked AS (
  SELECT *, CASE WHEN side = 1 THEN '' ELSE concat_ws('; ',
      CASE WHEN name <> 'note' AND text IS NULL THEN 'missing text'
           WHEN name = 'reply' AND length(text) NOT BETWEEN 1 AND 400 THEN 'range text'
           WHEN name = 'configure' AND length(text) NOT BETWEEN 1 AND 4000 THEN 'range text' END,
      CASE WHEN position IS NULL THEN 'missing turn'
           WHEN position < 0 OR (name = 'configure' AND position > 0) THEN 'range turn' END) END AS errors
  FROM every)
SELECT conv_id, id, CASE WHEN side = 0 THEN 'call' ELSE 'result' END AS kind, name, status, position, place,
  CAST(partner_place AS BIGINT) AS partner_place, errors = '' AS valid, errors,
  CASE WHEN side = 0 THEN '{"arguments":' || body || ',"id":' || coalesce(CAST(to_json(id) AS VARCHAR), 'null') || ',"name":"' || name || '"}'
    ELSE '{"content":' || coalesce(CAST(to_json(body) AS VARCHAR), 'null') || ',"tool_call_id":'
      || coalesce(CAST(to_json(id) AS VARCHAR), 'null') || '}' END AS json
FROM checked
"""
