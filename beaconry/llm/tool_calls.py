"""Chat formatting: tool calls linked to their results, put in order, checked and written as canonical JSON.

Calls and results are hash-joined by conversation and identifier. A call may name the call it needs (`after`);
its step is the length of that chain, found by pointer doubling, so a conversation of any length takes a
logarithmic number of rounds and no task holds a whole conversation. Arguments (a JSON object) are parsed to typed
values and checked against the tool's parameters by their JSON types. A line of canonical JSON has its keys
sorted at every depth, no white space, and numbers in one form. DataFrame functions only.

Defined cases: repeated calls or results count once, in whichever rows they stand; different calls with one
identifier in a conversation all stay, with the problem `clash`, and have the step of the smallest; of several
results of one call the smallest text is kept and their number reported; calls without result stay, results without
call are no row; an `after` that names no call starts a chain; calls on a cycle have step null and the problem
`cycle`; null or broken arguments, other JSON than an object, and a key given twice are the problem `arguments`; a
tool without schema is `unknown tool`; a JSON null counts as not given; a null conversation is one of its own, a call
with a null identifier stays and has no result. Columns are taken by name, others may have any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: JSON types, as Spark names them, that a value of each kind may have.
KINDS = {"integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "number": r"^(BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE)$", "boolean": "^BOOLEAN$", "string": "^STRING$",
         "object": "^OBJECT<", "array": "^ARRAY<"}


def json_text(value: Column) -> Column:
    """A JSON string literal of `value`, null for null."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))


def steps(calls: DataFrame) -> DataFrame:
    """(conv, call, step): calls before this one in its chain, null on a cycle. calls: conv, call, after."""
    known = calls.select("conv", F.col("call").alias("up"))
    nodes = calls.select("conv", "call", F.col("after").alias("up")).join(known.withColumn("there", F.lit(True)), ["conv", "up"], "left")
    nodes = stored(nodes.select("conv", "call", F.when(F.col("there"), F.col("up")).alias("up"),
                                F.when(F.col("there"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("step")), "steps")
    count, rounds = nodes.where("up is not null").count(), 0
    while count and 1 << rounds <= count + 1:   # beyond that many doublings only cycles are left
        above = nodes.select("conv", F.col("call").alias("up"), F.col("up").alias("next"), F.col("step").alias("more"))
        open_, done = nodes.where("up is not null"), nodes.where("up is null")
        nodes = stored(done.unionByName(open_.join(above, ["conv", "up"]).select("conv", "call", F.col("next").alias("up"), (F.col("step") + F.col("more")).alias("step"))), "steps")
        rounds += 1
        if nodes.where("up is not null").isEmpty():
            break
    return nodes.select("conv", "call", F.when(F.col("up").isNull(), F.col("step")).alias("step"))


def _named(column: str) -> Column:
    """A text that stands for an identifier, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-"))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per different call: conv, call, step, name, n_results, problem (null if it is sound), line.

    calls: conv, call, after, name, arguments; results: conv, call, content;
    schemas: name, param, kind, required."""
    calls = calls.select("conv", "call", "after", "name", "arguments").distinct()
    calls = calls.select("*", F.md5(F.to_json(F.struct("*")).cast("binary")).alias("row"), _named("conv").alias("in_conv"), _named("call").alias("ident"),
                         F.when(F.col("after").isNotNull(), _named("after")).alias("needs"))
    calls = stored(calls, "calls")   # read by every check below
    own = calls.groupBy("in_conv", "ident").agg(F.count("*").alias("alike"), F.min(F.struct("name", "arguments", "needs")).alias("c"))
    own = own.select("in_conv", "ident", "alike", F.col("c.needs").alias("needs"))
    order = steps(own.select(F.col("in_conv").alias("conv"), F.col("ident").alias("call"), F.col("needs").alias("after")))
    order = order.select(F.col("conv").alias("in_conv"), F.col("call").alias("ident"), "step")
    answers = results.where("call is not null").groupBy(_named("conv").alias("in_conv"), _named("call").alias("ident")).agg(
        F.count_distinct("content").alias("n_results"), F.min("content").alias("content"))
    given = calls.select("row", F.expr("try_cast(try_parse_json(arguments) as map<string,variant>)").alias("a"), F.try_parse_json("arguments").alias("v"))
    values = given.select("row", F.explode("a").alias("param", "value")).select("row", "param", F.schema_of_variant("value").alias("type"))
    # Every parameter of the tool beside what was given: missing, surplus and ill-typed ones show up as rows.
    beside = calls.select("row", "name").join(schemas, "name").drop("name").join(values.where("type <> 'VOID'"), ["row", "param"], "full")
    fits = F.lit(False)
    for kind, pattern in KINDS.items():
        fits = F.when(F.col("kind") == kind, F.col("type").rlike(pattern)).otherwise(fits)
    fault = (F.when(F.col("kind").isNull(), F.concat(F.lit("surplus "), "param"))
             .when(F.col("type").isNull() & F.col("required"), F.concat(F.lit("missing "), "param"))
             .when(F.col("type").isNotNull() & ~fits, F.concat(F.lit("not "), "kind", F.lit(" "), "param")))
    faults = beside.groupBy("row").agg(F.min(fault).alias("fault"))
    tools = schemas.select("name").distinct().withColumn("is_tool", F.lit(True))
    read = given.select("row", F.when(F.col("a").isNotNull(), F.to_json("v")).alias("body"))
    rows = (calls.join(own.select("in_conv", "ident", "alike"), ["in_conv", "ident"]).join(order, ["in_conv", "ident"]).join(answers, ["in_conv", "ident"], "left")
            .join(read, "row").join(faults, "row", "left").join(tools, "name", "left"))
    problem = (F.when(F.col("alike") > 1, F.lit("clash")).when(F.col("is_tool").isNull(), F.lit("unknown tool")).when(F.col("body").isNull(), F.lit("arguments"))
               .when(F.col("fault").isNotNull(), F.col("fault")).when(F.col("step").isNull(), F.lit("cycle")).when(F.col("n_results").isNull(), F.lit("no result")))
    null = F.lit("null")
    line = F.concat(F.lit('{"arguments":'), F.coalesce("body", F.lit("{}")), F.lit(',"id":'), F.coalesce(json_text(F.col("call")), null),
                    F.lit(',"name":'), F.coalesce(json_text(F.col("name")), null), F.lit(',"result":'), F.coalesce(json_text(F.col("content")), null), F.lit("}"))
    return rows.select("conv", "call", "step", "name", F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), problem.alias("problem"), line.alias("line"))


# --- calls and results in the turns of conversations ----------------------------------------------

#: The tools that the turns of `conversations` are read as calls of.
TOOLS = (("search", "query", "string", True), ("search", "limit", "integer", False), ("lookup", "query", "string", True), ("lookup", "exact", "boolean", True))


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every user turn is a call (`search`, or `lookup` if it asks in one sentence), the assistant turn behind it
    its result, and the user turn two before it the call it needs."""
    name = F.when(F.instr(F.col("text"), "\n") > 0, "search").otherwise("lookup")
    query = F.concat(F.lit('{"query":'), json_text(F.coalesce(F.col("text"), F.lit(""))))
    extra = F.when(name == "search", F.concat(F.lit(',"limit":'), F.length("text").cast("string"))).when(F.length("text") % 5 > 0, F.lit(',"exact":true')).otherwise("")
    ident = lambda shift: F.concat(F.lit("call_"), (F.col("turn") - shift).cast("string"))
    calls = conversations.where("role = 'user'").select(
        F.col("conv_id").alias("conv"), ident(0).alias("call"), ident(2).alias("after"), name.alias("name"), F.concat(query, extra, F.lit("}")).alias("arguments"))
    results = conversations.where("role = 'assistant'").select(F.col("conv_id").alias("conv"), ident(1).alias("call"), F.col("text").alias("content"))
    schemas = conversations.sparkSession.createDataFrame(list(TOOLS), "name string, param string, kind string, required boolean")
    return calls, results, schemas


def conversations_sql() -> str:
    """The rows of `link(*turns_as_calls(conversations))`, columns conv_id, call_id and so on, in DuckDB SQL."""
    return """WITH RECURSIVE c0 AS (SELECT conv_id AS conv, 'call_' || turn AS call, 'call_' || (turn - 2) AS after, coalesce(text, '') AS query, length(text) AS n,
 CASE WHEN instr(text, chr(10)) > 0 THEN 'search' ELSE 'lookup' END AS name FROM conversations WHERE role = 'user'),
calls AS (SELECT *, count(*) OVER (PARTITION BY conv, call) AS alike FROM (SELECT DISTINCT * FROM c0)),
idents AS (SELECT DISTINCT conv, call, after FROM calls),
answers AS (SELECT conv_id AS conv, 'call_' || (turn - 1) AS call, count(DISTINCT text) AS n_results, min(text) AS content FROM conversations WHERE role = 'assistant' GROUP BY 1, 2),
steps AS (SELECT conv, call, 0 AS step FROM idents a WHERE NOT EXISTS (SELECT 1 FROM idents b WHERE b.conv IS NOT DISTINCT FROM a.conv AND b.call = a.after)
 UNION ALL SELECT c.conv, c.call, s.step + 1 FROM idents c JOIN steps s ON s.conv IS NOT DISTINCT FROM c.conv AND s.call = c.after)
SELECT c.conv AS conv_id, c.call AS call_id, s.step::bigint AS step, c.name AS name, coalesce(n_results, 0)::bigint AS n_results,
 CASE WHEN alike > 1 THEN 'clash' WHEN c.name = 'lookup' AND NOT coalesce(n % 5 > 0, false) THEN 'missing exact' WHEN n_results IS NULL THEN 'no result' END AS problem,
 '{"arguments":{' || CASE WHEN c.name = 'search' THEN '"limit":' || n || ',' WHEN n % 5 > 0 THEN '"exact":true,' ELSE '' END || '"query":' || to_json(query)::varchar
 || '},"id":' || to_json(c.call)::varchar || ',"name":' || to_json(c.name)::varchar || ',"result":' || coalesce(to_json(content)::varchar, 'null') || '}' AS line
FROM calls c JOIN steps s ON s.conv IS NOT DISTINCT FROM c.conv AND s.call IS NOT DISTINCT FROM c.call LEFT JOIN answers a ON a.conv IS NOT DISTINCT FROM c.conv AND a.call = c.call"""
