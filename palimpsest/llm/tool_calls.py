"""Chat formatting: links tool calls with their results, orders them, validates arguments and serialises canonical JSON.
Native.

A message whose text is a JSON object with `tool_calls` (id, name, arguments, depends_on) holds calls; one with
`tool_call_id` and `content` is a result; any other text is plain. Calls and results meet in a hash join on conversation
and identifier. A call's level is one more than the highest of the calls it depends on, found in rounds that take off the
calls whose dependencies are done; its place in the conversation is the latest turn among itself and those before it.
One row comes out for each message, call and result; sorted by seq_turn, level, turn, n and part, a conversation's rows
are in topological order, each result right after its call. No conversation is ever gathered in one place.

Defined cases: null text is an empty plain message; text that begins like an object but does not parse is plain; of calls
with one identifier in a conversation the first (by turn, then place) counts and later ones are `duplicate_id`; of
several results of a call the first counts and later ones are `repeated`; a result without a call is `orphan` and keeps
its turn; a call without a result is `no_result`; an identifier that no call of the conversation has is no dependency;
calls on a cycle, or behind one, are `cycle`, with level null, at their own turn. A null conv_id is a conversation of its
own. A null identifier links with nothing. A call whose arguments are no JSON object, or whose tool has no schema, is
not valid. Repeated rows are each a row; extra columns are ignored; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.common import cut, read

_ENVELOPE = (
    "tool_calls array<struct<id string, name string, arguments string, depends_on array<string>>>, "
    "tool_call_id string, content string"
)
_KINDS = {
    "string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT"],
    "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"], "null": ["VOID"],
}
KEYS = ["seq_turn", "level", "turn", "n", "part"]


def quoted(c: Column) -> Column:
    """c as a JSON value; null is null."""
    j = F.to_json(F.struct(c.alias("x")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.substring(j, F.lit(6), F.length(j) - 6))


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no spaces; null if it does not parse."""
    return F.to_json(F.try_parse_json(json))


def valid_arguments(arguments: Column, schema: dict) -> Column:
    """Does the JSON text meet the schema: type, required, additionalProperties, enum, minLength, minimum, maximum."""
    v, keys = F.try_parse_json(arguments), F.json_object_keys(arguments)
    fields = schema.get("properties", {})
    ok = F.schema_of_variant(v).startswith("OBJECT")
    for name in schema.get("required", []):
        ok = ok & F.array_contains(keys, name)
    if not schema.get("additionalProperties", True):
        ok = ok & (F.size(F.array_except(keys, F.array(*map(F.lit, fields)) if fields else F.array().cast("array<string>"))) == 0)
    for name, want in fields.items():
        path = f"$['{name}']"
        kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
        good = F.lit(True)
        if "type" in want:
            good = F.lit(False)
            for k in _KINDS[want["type"]]:
                good = good | kind.startswith(k)
        text, number = F.try_variant_get(v, path, "string"), F.try_variant_get(v, path, "double")
        if "enum" in want:
            good = good & text.isin(*want["enum"])
        if "minLength" in want:
            good = good & (F.length(text) >= want["minLength"])
        if "minimum" in want:
            good = good & (number >= want["minimum"])
        if "maximum" in want:
            good = good & (number <= want["maximum"])
        ok = ok & (~F.array_contains(keys, name) | F.coalesce(good, F.lit(False)))
    return F.coalesce(ok, F.lit(False))


def _valid(tools: dict[str, dict]) -> Column:
    out = F.lit(False)
    for name, schema in tools.items():
        out = F.when(F.col("name") == name, valid_arguments(F.col("arguments"), schema)).otherwise(out)
    return out


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, c (the conversation as a join key), turn, role, text, e (the envelope, null for plain text)."""
    m = messages.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")).alias("c"), "turn", "role", "text")
    e = F.when(F.col("text").startswith("{"), F.from_json("text", _ENVELOPE))
    return m.withColumn("e", F.when(e.tool_calls.isNotNull() | e.tool_call_id.isNotNull(), e))


def levels(calls: DataFrame) -> DataFrame:
    """calls: c, id, turn, deps. Gives c, id, level, seq_turn of the calls that no cycle holds back."""
    nodes = calls.select("c", "id", "turn")
    edges = calls.select("c", "id", F.explode(F.array_distinct("deps")).alias("dep")).filter("dep is not null")
    known = nodes.select("c", F.col("id").alias("dep"))
    edges = cut(edges.join(known, ["c", "dep"]))
    waiting = edges.groupBy("c", "id").agg(F.count("*").alias("open"))
    state = cut(nodes.join(waiting, ["c", "id"], "left").select("c", "id", F.col("turn").alias("seq_turn"), F.coalesce("open", F.lit(0)).alias("open")))
    done, k = [], 0
    while True:
        ready = state.filter("open <= 0").select("c", "id", F.lit(k).alias("level"), "seq_turn")
        done.append(ready)
        rest = state.filter("open > 0")
        if rest.isEmpty():
            break
        freed = edges.join(ready.select("c", F.col("id").alias("dep"), F.col("seq_turn").alias("s")), ["c", "dep"])
        freed = freed.groupBy("c", "id").agg(F.count("*").alias("m"), F.max("s").alias("s"))
        if freed.isEmpty():
            break
        state = cut(rest.join(freed, ["c", "id"], "left").select(
            "c", "id", F.greatest("seq_turn", F.coalesce("s", "seq_turn")).alias("seq_turn"), (F.col("open") - F.coalesce("m", F.lit(0))).alias("open")
        ))
        k += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def link(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """messages: conv_id, turn, role, text. Gives conv_id, seq_turn, level, turn, n, part (message, call or result),
    call_id, status, valid, json."""
    m = cut(parsed(messages))  # texts are parsed once
    calls = m.select("conv_id", "c", "turn", F.posexplode("e.tool_calls").alias("n", "t")).select(
        "conv_id", "c", "turn", "n", "t.id", "t.name", F.coalesce(canonical(F.col("t.arguments")), F.lit("null")).alias("arguments"),
        F.coalesce("t.depends_on", F.array().cast("array<string>")).alias("deps"),
    )
    calls = calls.withColumn("valid", _valid(tools))
    results = m.filter("e.tool_call_id is not null").select("conv_id", "c", "turn", F.col("e.tool_call_id").alias("id"), F.col("e.content").alias("content"))

    first = calls.filter("id is not null").groupBy("c", "id").agg(F.min_by(F.struct("turn", "n", "deps"), F.struct("turn", "n")).alias("f"))
    first = cut(first.select("c", "id", "f.turn", "f.n", "f.deps"))
    place = levels(first)
    answered = results.groupBy("c", "id").agg(F.min("turn").alias("answer"))
    known = cut(
        first.select("c", "id", F.col("turn").alias("f_turn"), F.col("n").alias("f_n"))
        .join(place, ["c", "id"], "left")
        .join(answered.hint("shuffle_hash"), ["c", "id"], "left")
    )
    x = calls.join(known.hint("shuffle_hash"), ["c", "id"], "left")
    is_first = (F.col("turn") == F.col("f_turn")) & (F.col("n") == F.col("f_n"))
    status = (
        F.when(F.col("id").isNull() | ~is_first, F.when(F.col("id").isNull(), "no_result").otherwise("duplicate_id"))
        .when(F.col("level").isNull(), "cycle").when(F.col("answer").isNull(), "no_result").otherwise("linked")
    )
    counts = F.coalesce(is_first, F.lit(False))
    call_rows = x.select(
        "conv_id", F.when(counts, F.coalesce("seq_turn", "turn")).otherwise(F.col("turn")).alias("seq_turn"),
        F.when(counts, F.col("level")).alias("level"), "turn", "n", F.lit("call").alias("part"), F.col("id").alias("call_id"),
        status.alias("status"), "valid",
        F.concat(F.lit('{"arguments":'), "arguments", F.lit(',"id":'), quoted(F.col("id")), F.lit(',"name":'), quoted(F.col("name")), F.lit(',"type":"tool_call"}')).alias("json"),
    )
    y = results.join(known.hint("shuffle_hash"), ["c", "id"], "left")
    state = F.when(F.col("f_turn").isNull(), "orphan").when(F.col("turn") > F.col("answer"), "repeated").otherwise("linked")
    here = state == "linked"
    result_rows = y.select(
        "conv_id", F.when(here, F.coalesce("seq_turn", "f_turn")).otherwise(F.col("turn")).alias("seq_turn"), F.when(here, F.col("level")).alias("level"),
        F.when(here, F.col("f_turn")).otherwise(F.col("turn")).alias("turn"), F.when(here, F.col("f_n")).otherwise(0).alias("n"), F.lit("result").alias("part"),
        F.col("id").alias("call_id"), state.alias("status"), F.lit(None).cast("boolean").alias("valid"),
        F.concat(F.lit('{"content":'), quoted(F.col("content")), F.lit(',"id":'), quoted(F.col("id")), F.lit(',"type":"tool_result"}')).alias("json"),
    )
    plain = m.filter("e is null").select(
        "conv_id", F.col("turn").alias("seq_turn"), F.lit(-1).alias("level"), "turn", F.lit(0).alias("n"), F.lit("message").alias("part"),
        F.lit(None).cast("string").alias("call_id"), F.lit("plain").alias("status"), F.lit(None).cast("boolean").alias("valid"),
        F.concat(F.lit('{"content":'), quoted(F.coalesce("text", F.lit(""))), F.lit(',"role":'), quoted(F.col("role")), F.lit(',"type":"message"}')).alias("json"),
    )
    return plain.unionByName(call_rows).unionByName(result_rows)


#: The tool of the dialogue below.
ASK = {
    "ask": {
        "properties": {"text": {"type": "string", "minLength": 30}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["text", "turn"],
        "additionalProperties": False,
    }
}


def as_tool_dialogue(conversations: DataFrame) -> DataFrame:
    """Every user turn as a call of `ask` that builds on the one at half its turn, every assistant turn as the result
    of the turn before; system turns stay plain."""
    call = F.to_json(F.struct(F.array(F.struct(
        F.concat(F.lit("t"), F.col("turn").cast("string")).alias("id"), F.lit("ask").alias("name"),
        F.struct("turn", "text").alias("arguments"),
        F.when(F.col("turn") > 0, F.array(F.concat(F.lit("t"), (F.floor(F.col("turn") / 4) * 2).cast("string")))).alias("depends_on"),
    )).alias("tool_calls")))
    result = F.to_json(F.struct(F.concat(F.lit("t"), (F.col("turn") - 1).cast("string")).alias("tool_call_id"), F.col("text").alias("content")))
    text = F.when(F.col("role") == "user", call).when(F.col("role") == "assistant", result).otherwise(F.col("text"))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def op3(spark, sf_dir):
    return link(as_tool_dialogue(read(spark, sf_dir, "conversations")), ASK)


ORACLE = """
with recursive q as (select conv_id, turn, text, 't' || turn as id, case when turn > 0 then 't' || (turn // 4 * 2) end as dep
  from conversations where role = 'user'),
a as (select conv_id, turn, text, 't' || (turn - 1) as id from conversations where role = 'assistant'),
l(conv_id, id, level, turn, seq_turn) as (
  select q.conv_id, q.id, 0, q.turn, q.turn from q left join q d on d.conv_id = q.conv_id and d.id = q.dep where d.id is null
  union all
  select q.conv_id, q.id, l.level + 1, q.turn, greatest(q.turn, l.seq_turn) from l join q on q.conv_id = l.conv_id and q.dep = l.id)
select conv_id, turn as seq_turn, -1 as level, turn, 0 as n, 'message' as part, cast(null as varchar) as call_id, 'plain' as status,
  cast(null as boolean) as valid, '{"content":' || cast(to_json(text) as varchar) || ',"role":' || cast(to_json(role) as varchar) || ',"type":"message"}' as json
  from conversations where role not in ('user', 'assistant')
union all
select q.conv_id, l.seq_turn, l.level, q.turn, 0, 'call', q.id, case when a.id is null then 'no_result' else 'linked' end, length(q.text) >= 30,
  '{"arguments":{"text":' || cast(to_json(q.text) as varchar) || ',"turn":' || q.turn || '},"id":"' || q.id || '","name":"ask","type":"tool_call"}'
  from q join l using (conv_id, id) left join a on a.conv_id = q.conv_id and a.id = q.id
union all
select a.conv_id, coalesce(l.seq_turn, a.turn), l.level, coalesce(l.turn, a.turn), 0, 'result', a.id,
  case when l.id is null then 'orphan' else 'linked' end, null, '{"content":' || cast(to_json(a.text) as varchar) || ',"id":"' || a.id || '","type":"tool_result"}'
  from a left join l on a.conv_id = l.conv_id and a.id = l.id
"""
