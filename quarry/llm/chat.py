"""Chat formatting: tool calls linked to results, ordered by dependency, validated and written as canonical JSON.

Rows stay one a message, call or result, so a conversation of any length is never gathered in one task; sorting by
(conv_id, order_turn, order_level, order_part, order_item) puts them in their final order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize, release

CALL = "struct<id:string,name:string,arguments:string,after:array<string>>"
#: JSON types by the name that a schema gives them.
KINDS = {"string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "boolean": r"^BOOLEAN$", "object": r"^OBJECT", "array": r"^ARRAY", "null": r"^VOID$"}


def parse_turns(turns: DataFrame) -> DataFrame:
    """One row for each message, call and result of the turns, with what the markup says of it.

    A turn whose text is a JSON object with ``tool_calls`` (a list of id, name, arguments, after) makes those calls and,
    if it has ``content``, a message. A ``<tool_call>{...}</tool_call>`` tag makes a call; the text without tags is the
    message. A turn of role tool whose text is an object with ``tool_call_id`` is that call's result. Anything else is a message.
    """
    text = F.col("text")
    whole = F.from_json(F.when(text.rlike(r"(?s)^\s*\{.*\}\s*$"), text), f"struct<tool_calls:array<{CALL}>,content:string,tool_call_id:string>")
    tags = F.transform(F.regexp_extract_all(text, F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), F.lit(1)), lambda t: F.from_json(t, CALL))
    t = turns.select("conv_id", "turn", "role", "text").withColumn("j", whole).withColumn("tags", F.when(text.contains("<tool_call>"), tags))
    calls = F.coalesce(F.col("j.tool_calls"), F.col("tags"), F.array().cast(f"array<{CALL}>"))
    is_result = (F.col("role") == "tool") & F.col("j.tool_call_id").isNotNull()
    said = F.when(F.col("j.tool_calls").isNotNull(), F.col("j.content")).when(F.size(F.coalesce("tags", F.array().cast(f"array<{CALL}>"))) > 0, F.nullif(F.trim(F.regexp_replace("text", r"(?s)<tool_call>.*?</tool_call>", "")), F.lit(""))).otherwise(text)
    has_message = F.coalesce(F.size(calls) == 0, F.lit(True)) | said.isNotNull()
    none = F.lit(None)
    item = "array<struct<part:int,item:int,id:string,name:string,arguments:string,after:array<string>,content:string>>"
    one = F.array(F.struct(F.when(is_result, 2).otherwise(0).alias("part"), F.lit(0).alias("item"), F.when(is_result, F.col("j.tool_call_id")).alias("id"), none.alias("name"), none.alias("arguments"), none.alias("after"), F.when(is_result, F.col("j.content")).otherwise(said).alias("content"))).cast(item)
    many = F.transform(calls, lambda c, i: F.struct(F.lit(1).alias("part"), i.alias("item"), c["id"].alias("id"), c["name"].alias("name"), c["arguments"].alias("arguments"), c["after"].alias("after"), none.alias("content"))).cast(item)
    items = F.when(is_result, one).when(has_message, F.concat(one, many)).otherwise(many)
    return t.select("conv_id", "turn", "role", F.explode(items).alias("x")).select("conv_id", "turn", "role", "x.*")


def _objections(v: Column, rule: dict, where: str) -> list[Column]:
    """Columns that are null or say what is wrong with the variant ``v`` by its rule; ``where`` names it."""
    found = []
    if kind := rule.get("type"):
        found.append(F.when(v.isNotNull() & ~F.schema_of_variant(v).rlike(KINDS[kind]), f"{where} is not {kind}"))
    if "enum" in rule:
        listed = F.coalesce(F.try_variant_get(v, "$", "string").isin(*map(str, rule["enum"])), F.lit(False))
        found.append(F.when(v.isNotNull() & ~listed, f"{where} is not allowed"))
    number, text = F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "string")
    is_number = F.schema_of_variant(v).rlike(KINDS["number"])
    for key, bad, word in (("minimum", lambda x, y: x < y, "below"), ("maximum", lambda x, y: x > y, "above")):
        if key in rule:
            found.append(F.when(is_number & bad(number, F.lit(float(rule[key]))), f"{where} is {word} {rule[key]}"))
    if "pattern" in rule:
        found.append(F.when(F.schema_of_variant(v).rlike(KINDS["string"]) & ~text.rlike(rule["pattern"]), f"{where} does not match"))
    if "items" in rule:
        each = F.try_variant_get(v, "$", "array<variant>")

        def wrong_item(k: int):
            return lambda x: _objections(x, rule["items"], f"an item of {where}")[k]

        for k in range(len(_objections(F.lit(None).cast("variant"), rule["items"], ""))):
            wrong = F.transform(each, wrong_item(k))
            found.append(F.try_element_at(F.array_compact(wrong), F.lit(1)))
    prefix = f"{where}." if where else ""
    for p in rule.get("required", []):
        found.append(F.when(_is_object(v) & F.try_variant_get(v, f"$.{p}", "variant").isNull(), f"missing {prefix}{p}"))
    for p, inner in sorted(rule.get("properties", {}).items()):
        found += _objections(F.try_variant_get(v, f"$.{p}", "variant"), inner, f"{prefix}{p}")
    if not rule.get("additionalProperties", True):
        extra = F.array_except(F.json_object_keys(F.to_json(v)), F.array(*[F.lit(p) for p in rule.get("properties", {})]).cast("array<string>"))
        found.append(F.when(_is_object(v) & (F.size(extra) > 0), F.concat(F.lit(f"unexpected {prefix}"), F.array_join(F.array_sort(extra), ","))))
    return found


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def problems(name: Column, args: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with a call's arguments (a variant) by the schema of its tool: an array of texts, sorted.

    Schemas may nest: type, enum, minimum, maximum, pattern, items, properties, required and additionalProperties count at every depth;
    of the items of an array the first that is wrong is told.
    """
    out = F.array(F.lit("unknown tool"))
    for tool, s in sorted(schemas.items()):
        found = _objections(args, {k: v for k, v in s.items() if k != "type"}, "")
        listed = F.array_sort(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")
        out = F.when(name == tool, listed).otherwise(out)
    shape = F.when(args.isNull(), F.array(F.lit("arguments are not JSON"))).when(~_is_object(args), F.array(F.lit("arguments are not an object")))
    return F.coalesce(shape, out)


KEY = ["conv_id", "id"]


def dependency_levels(calls: DataFrame) -> DataFrame:
    """(conv_id, id, level) of the calls that can be ordered; calls on a cycle, or after one, have no row.

    Level 0 waits for nothing; another is one more than the greatest level it waits for. A dependency on an unknown id is
    ignored. Calls that wait for one other are pointed past each other, twice as far in every round, to the first call
    ahead that waits for none or for several, so a chain of n calls takes log2(n) rounds. Rounds over the calls that
    wait for several are as many as the longest chain of those.
    """
    ids = calls.select(*KEY)
    waits = calls.select(*KEY, F.explode("after").alias("dep")).where("dep is not null").distinct()
    waits = waits.join(ids.select("conv_id", F.col("id").alias("dep")), ["conv_id", "dep"], "left_semi").select(*KEY, "dep")
    waits = materialize(waits, "waits")
    if waits.isEmpty():
        return ids.withColumn("level", F.lit(0))
    one = materialize(waits.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("dep").alias("to")).where("n = 1").select(*KEY, "to", F.lit(1).alias("dist")), "jumps")
    for _ in range(one.count().bit_length() + 1):
        ahead = one.select("conv_id", F.col("id").alias("to"), F.col("to").alias("far"), F.col("dist").alias("more"))
        after = materialize(one.join(ahead, ["conv_id", "to"], "left").select(*KEY, F.coalesce("far", "to").alias("to"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), F.col("far").isNotNull().alias("moved")), "jumps")
        left = after.where("moved").count()
        release(one)
        one = after
        if not left:
            break
    single = one.where("not moved").drop("moved")  # those that still move are on a cycle of single waits, or behind one
    stuck = one.where("moved").select(*KEY)
    several = waits.join(one.select(*KEY), KEY, "left_anti")
    jump = one.select("conv_id", F.col("id").alias("dep"), "to", "dist", "moved")
    several = several.join(jump, ["conv_id", "dep"], "left").select(*KEY, F.when(F.coalesce("moved", F.lit(False)), F.lit(None)).otherwise(F.coalesce("to", "dep")).alias("dep"), F.coalesce("dist", F.lit(0)).alias("dist"))
    several = materialize(several, "several")
    done = materialize(ids.join(waits.select(*KEY).distinct(), KEY, "left_anti").withColumn("level", F.lit(0)), "levels")
    n = done.count()
    while not several.isEmpty():
        dep = done.select("conv_id", F.col("id").alias("dep"), F.col("level").alias("at"))
        ready = several.join(dep, ["conv_id", "dep"], "left").groupBy(*KEY).agg(F.max(F.col("at") + F.col("dist")).alias("at"), F.count_if(F.col("at").isNull()).alias("open")).where("open = 0")
        new = ready.select(*KEY, (F.col("at") + 1).cast("int").alias("level")).join(done.select(*KEY), KEY, "left_anti")
        after = materialize(done.union(new), "levels")
        release(done)
        done, now = after, after.count()
        if now == n:
            break
        n = now
    at = done.select("conv_id", F.col("id").alias("to"), F.col("level").alias("base"))
    chains = single.join(at, ["conv_id", "to"]).select(*KEY, (F.col("base") + F.col("dist")).cast("int").alias("level"))
    return done.union(chains.join(stuck, KEY, "left_anti"))


def format_chat(turns: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Canonical rows of all conversations.

    Columns: conv_id, turn, kind (message, call or result), call_id, order_turn, order_level, order_part, order_item,
    problem (null if none), json. A result stands after its call, at the call's turn, and a call after those it waits
    for. JSON has sorted keys and no spaces; arguments are rewritten so at every depth. Problems, joined with "; ": of a call
    no id, duplicate id (all but the first by turn and place), cycle, no result, and what its schema objects to; of a result:
    no call, before its call, duplicate result. A row with a problem stays. Null texts are messages with null content; rows
    with a null conv_id or turn stay and link with nothing. Repeated turns stay, as duplicates; empty input gives an empty result.
    """
    rows = materialize(parse_turns(turns), "chat")
    messages = rows.where("part = 0").select("conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), F.col("turn").alias("order_turn"), F.lit(0).alias("order_level"), "part", "item", F.lit(None).cast("string").alias("problem"), F.to_json(F.struct("content", "role", "turn"), {"ignoreNullFields": "false"}).alias("json"))
    if rows.where("part > 0").isEmpty():
        return _named(messages)
    rows = rows.where("part > 0").withColumn("__n", F.monotonically_increasing_id())
    calls = rows.where("part = 1").withColumn("args", F.try_parse_json("arguments"))
    calls = calls.withColumn("bad", problems(F.col("name"), F.col("args"), schemas)).withColumn("arguments", F.coalesce(F.to_json("args"), F.to_json(F.struct("arguments"), {"ignoreNullFields": "false"}).substr(F.lit(14), F.length(F.to_json(F.struct("arguments"), {"ignoreNullFields": "false"})) - 14))).drop("args")
    calls, results = _ranked(materialize(calls, "calls"), "item", "arguments"), _ranked(materialize(rows.where("part = 2"), "results"), "content")
    first = calls.where("first and linked")
    levels = materialize(dependency_levels(first), "level")
    answered = results.where("linked").groupBy(*KEY).agg(F.count("*").alias("answers"))
    c = _met(calls, levels, answered)
    said = F.array(
        F.when(F.col("id").isNull(), "no id"),
        F.when(~F.col("first"), "duplicate id"),
        F.when(F.col("first") & F.col("linked") & F.col("level").isNull(), "cycle"),
        F.when(F.col("answers").isNull(), "no result"),
    )
    problem = F.nullif(F.array_join(F.concat(F.array_compact(said), "bad"), "; "), F.lit(""))
    quoted = lambda k, v: F.coalesce(F.to_json(F.struct(v.alias(k))).substr(F.lit(2), F.length(F.to_json(F.struct(v.alias(k)))) - 2), F.lit(f'"{k}":null'))
    text = lambda k: F.when(F.col(k).isNull(), F.lit(f'"{k}":null')).otherwise(quoted(k, F.col(k)))
    json = F.concat(F.lit('{"arguments":'), F.col("arguments"), F.lit(","), text("id"), F.lit(","), text("name"), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"))
    c = c.select("conv_id", "turn", F.lit("call").alias("kind"), F.col("id").alias("call_id"), F.col("turn").alias("order_turn"), F.coalesce("level", F.lit(0)).alias("order_level"), "part", "item", problem.alias("problem"), json.alias("json"))
    at = first.join(levels, ["conv_id", "id"], "left").select("conv_id", "id", F.col("turn").alias("call_turn"), F.coalesce("level", F.lit(0)).alias("level"), F.col("item").alias("call_item"))
    r = _met(results, at)
    said = F.array(F.when(F.col("call_turn").isNull(), "no call"), F.when(F.col("turn") < F.col("call_turn"), "before its call"), F.when(~F.col("first"), "duplicate result"))
    content = F.coalesce(F.to_json(F.try_parse_json("content")), F.lit(None))
    body = F.when(F.col("content").isNull(), F.lit("null")).when(content.rlike(r"^[\[{]"), content).otherwise(quoted("content", F.col("content")).substr(F.lit(11), F.length(quoted("content", F.col("content")))))
    json = F.concat(F.lit('{"content":'), body, F.lit(',"role":"tool",'), quoted("tool_call_id", F.col("id")), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"))
    r = r.select("conv_id", "turn", F.lit("result").alias("kind"), F.col("id").alias("call_id"), F.coalesce("call_turn", "turn").alias("order_turn"), F.coalesce("level", F.lit(0)).alias("order_level"), "part", F.coalesce("call_item", "item").alias("item"), F.nullif(F.array_join(F.array_compact(said), "; "), F.lit("")).alias("problem"), json.alias("json"))
    return _named(messages.union(c).union(r))


def _met(rows: DataFrame, *sides: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``sides`` by key; rows without a key are not shuffled."""
    keyed = rows.where("linked")
    for s in sides:
        keyed = keyed.join(s, KEY, "left")
    return keyed.unionByName(rows.where("not linked"), allowMissingColumns=True)


def _ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``linked`` (conv_id and id are known) and ``first``: whether a row is the first of its key, by turn, order and place.

    The first of a key is a partial aggregate joined back, so a key with many rows is not gathered; rows without a key do not shuffle.
    """
    linked = F.col("conv_id").isNotNull() & F.col("id").isNotNull()
    keyed = rows.where(linked)
    least = keyed.groupBy(*KEY).agg(F.min(F.struct(F.col("turn").isNull().alias("x"), "turn", *order, "__n"))["__n"].alias("__first"))
    keyed = keyed.join(least, KEY).withColumn("first", F.col("__n") == F.col("__first")).drop("__first").withColumn("linked", F.lit(True))
    loose = rows.where(~linked).withColumn("first", F.lit(True)).withColumn("linked", F.lit(False))
    return keyed.unionByName(loose)


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("part", "order_part").withColumnRenamed("item", "order_item")
