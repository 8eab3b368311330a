"""Benchmark questions in documents, also with other numbers, names or units in them.

Both sides are turned into templates: words without case and punctuation, with numbers, names
(capitalised inside a sentence) and units (after a number) replaced by a placeholder of their kind.
Windows of five template words are hash-joined. Where a matched window has placeholders, the values are
checked: at one alignment of document and question, a value of the question must always be replaced by the
same value of the document, else the windows that hold this value do not count there. A document holds a
question if it has four fifths of the question's windows, or `LONG` of them (a passage of a longer question).

Template windows with fewer than `LITERALS` plain words say nothing and are left out on the question's behalf.
Windows of the words as they stand, without case, are joined too and need neither: a document also holds a question
if windows of either sort stand at four fifths of all its places, or at `LONG` of them (then `n_windows` and
`item_windows` count those places). So verbatim copies are found whatever they consist of, and in any case. A question of under five words is one window, which only a document of just these words has.
The questions' windows are broadcast after they were counted, up to `BROADCAST_ROWS`; beyond that the join is
an ordinary one. DataFrame functions only.

Defined cases: null and empty text has no windows; questions without a telling window match verbatim; a null
item is an item; repeated questions or documents are each reported; a repeated (id, text) document row is reported once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import nested, row_keys, unnested

WORDS, LITERALS, SHARE, LONG = 5, 3, 0.8, 16
BROADCAST_ROWS = 1_000_000   # of 8 to 40 bytes
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
_TOKEN = r"\p{L}+|[0-9]+(?:[.,][0-9]+)*|[%$€£°]|[.!?:\n]+"
#: Units and their short forms.
UNITS = ("%", "$", "€", "£", "°", "mm", "cm", "m", "km", "mg", "g", "kg", "ml", "cl", "l", "s", "min", "h", "ms", "hz", "khz", "mhz", "w", "kw", "kwh",
         "v", "a", "j", "kj", "n", "pa", "bar", "k", "c", "f", "usd", "eur", "gbp", "cents", "cent", "dollars", "dollar", "euros", "euro", "pounds", "pound",
         "miles", "mile", "meters", "meter", "metres", "metre", "kilometers", "kilometer", "feet", "foot", "inches", "inch", "yards", "yard", "grams",
         "gram", "kilograms", "kilogram", "tons", "ton", "liters", "liter", "litres", "litre", "gallons", "gallon", "seconds", "second", "minutes",
         "minute", "hours", "hour", "days", "day", "weeks", "week", "months", "month", "years", "year", "percent", "degrees", "degree")


def _pairs(text: Column) -> Column:
    """Each token beside the one before it: a lambda that named the array would evaluate it for every token."""
    raw = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))
    return F.arrays_zip(raw.alias("t"), F.concat(F.array(F.lit(None).cast("string")), raw).alias("before"))


def template(text: Column) -> Column:
    """array<struct<c, v>>: template word, and the value that a placeholder stands for (null for a plain word)."""
    words = F.transform(_pairs(text), lambda p: F.struct(_kind(p["t"], p["before"]).alias("c"), F.lower(p["t"]).alias("low")))
    words = F.filter(words, lambda w: w["c"].isNotNull())
    return F.transform(words, lambda w: F.struct(w["c"].alias("c"), F.when(w["c"].isin(NUMBER, NAME, UNIT), w["low"]).alias("v")))


def template_words(text: Column) -> Column:
    """array<struct<c, low>>: template word and the word itself in lower case."""
    words = F.transform(_pairs(text), lambda p: F.struct(_kind(p["t"], p["before"]).alias("c"), F.lower(p["t"]).alias("low")))
    return F.filter(words, lambda w: w["c"].isNotNull())


def _kind(t: Column, before: Column) -> Column:
    """Template word of a token; null for a mark, and behind the last token.

    Tokens start with a mark, a digit, a sign or a letter, so their place in byte order tells which:
    digits lie from "0" to below ":", letters from "A" on, what else is below "A" is a mark or one of two signs."""
    low = F.lower(t)
    digit = lambda x: (x >= "0") & (x < ":")
    unit = t.isin(*UNITS[:5]) | (digit(before) & low.isin(*UNITS))
    inside = (before >= "A") | digit(before) | before.isin("%", "$")
    first = F.substring(t, 1, 1)
    name = (low != t) & inside & (F.lower(first) != first)
    return (F.when(t.isNull(), F.lit(None).cast("string")).when(digit(t), NUMBER).when(unit, UNIT)
            .when(t < "A", F.lit(None).cast("string")).when(name, NAME).otherwise(low))


def _windows(words: Column, *seed: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (WORDS - 1), F.lit(1))),
                       lambda i: F.xxhash64(*seed, F.slice(words, i, WORDS)))


def question_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Windows of each question: item, place, raw, h, slots (offset, kind, value; none if raw), n (telling windows of the item), places (all)."""
    rows = benchmark.select(F.col(id_col).alias("item"), template(F.col(text_col)).alias("t")).where("size(t) > 0")
    rows = rows.select("item", "t", F.transform("t", lambda w: w["c"]).alias("c"), F.transform("t", lambda w: F.coalesce(w["v"], w["c"])).alias("low")).distinct()
    both = F.arrays_zip(_windows(F.col("c")).alias("h"), _windows(F.col("low"), F.lit(1)).alias("r"))
    at = rows.select("item", "t", F.posexplode(both).alias("place", "w"))
    part = F.slice("t", F.col("place") + 1, WORDS)
    slots = F.filter(F.transform(part, lambda w, i: F.struct(i.alias("offset"), w["c"].alias("kind"), w["v"].alias("value"))), lambda s: s["value"].isNotNull())
    at = at.select("item", "place", "w", F.size(part).alias("words"), slots.alias("slots"))
    at = at.withColumn("telling", F.col("words") - F.size("slots") >= F.least(F.lit(LITERALS), F.col("words")))
    counts = at.groupBy(F.col("item").alias("_item")).agg(F.count_distinct(F.when(F.col("telling"), F.col("place"))).alias("n"), F.count_distinct("place").alias("places"))
    at = at.join(counts, F.col("item").eqNullSafe(F.col("_item")))
    none = F.filter("slots", lambda s: F.lit(False))
    template_ = at.where("telling").select("item", "place", F.lit(False).alias("raw"), F.col("w.h").alias("h"), "slots", "n", "places")
    return template_.union(at.select("item", "place", F.lit(True), "w.r", none, "n", "places"))


def leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """(id, item, n_windows, item_windows, n_changed) of every document and question it holds; also k1, k2 of the row."""
    questions = question_windows(benchmark, item_col)
    if questions.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        questions = F.broadcast(questions)
    keyed = documents.select(F.col(id_col).alias("id"), F.xxhash64(id_col).alias("k1"), F.xxhash64(text_col).alias("k2"), F.col(text_col).alias("text"))
    # A filter on the words would be pushed below them and work them out a second time, so the short windows at the end go after the explode.
    words = keyed.select("id", "k1", "k2", template_words(F.col("text")).alias("c"))
    beside = F.arrays_zip(*[F.slice("c", i + 1, F.size("c")).alias(f"w{i}") if i else F.col("c").alias("w0") for i in range(WORDS)])
    windows = words.select("id", "k1", "k2", F.posexplode(beside).alias("at", "w")).where(f"at = 0 or w.w{WORDS - 1} is not null")
    hashes = F.array(F.xxhash64(*[F.col(f"w.w{i}.c") for i in range(WORDS)]), F.xxhash64(F.lit(1), *[F.col(f"w.w{i}.low") for i in range(WORDS)]))
    windows = windows.select("id", "k1", "k2", "at", F.posexplode(hashes).alias("sort", "h")).withColumn("raw", F.col("sort") == 1)
    hits = windows.join(questions, ["h", "raw"]).select("id", "k1", "k2", "item", "at", "place", "raw", "slots", "n", "places", (F.col("at") - F.col("place")).alias("shift"))
    hits = hits.dropDuplicates(["k1", "k2", "item", "at", "place", "raw"])
    doc = ["k1", "k2", "item"]
    if not questions.where(F.size("slots") > 0).isEmpty():
        slotted = hits.where(F.size("slots") > 0).select(*doc, "shift", "at", F.explode("slots").alias("s"))
        values = keyed.select("k1", "k2", F.transform(template(F.col("text")), lambda w: w["v"]).alias("v"))
        wanted = slotted.groupBy("k1", "k2").agg(F.collect_set(F.struct("item", "shift", (F.col("at") + F.col("s.offset")).alias("at"), F.col("s.kind").alias("kind"), F.col("s.value").alias("old"))).alias("w"))
        pairs = values.join(wanted, ["k1", "k2"]).select("k1", "k2", "v", F.explode("w").alias("w")).select(
            "k1", "k2", "w.item", "w.shift", "w.kind", "w.old", F.get("v", F.col("w.at")).alias("new")).distinct()
        per_value = pairs.groupBy(*doc, "shift", "kind", "old").agg(F.count("*").alias("c"), F.max((F.col("old") != F.col("new")).cast("int")).alias("other"))
        changed = per_value.groupBy(*doc, "shift").agg(
            F.sum(F.when(F.col("c") == 1, F.col("other")).otherwise(0)).alias("n_changed"),
            F.collect_list(F.when(F.col("c") > 1, F.concat("kind", "old"))).alias("torn"))
        changed = changed.withColumnsRenamed({c: f"_{c}" for c in (*doc, "shift")})
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*doc, "shift")]
        held = F.transform("slots", lambda s: F.concat(s["kind"], s["value"]))
        hits = hits.join(changed, same, "left").where(~F.coalesce(F.arrays_overlap(held, "torn"), F.lit(False)))
    else:
        hits = hits.withColumn("n_changed", F.lit(0).cast("long"))
    found = hits.groupBy("k1", "k2", "id", "item").agg(
        F.count_distinct(F.when(~F.col("raw"), F.col("place"))).alias("n_windows"), F.max("n").alias("item_windows"), F.count_distinct("place").alias("n_places"),
        F.max("places").alias("places"), F.coalesce(F.max(F.when(~F.col("raw"), F.col("n_changed"))), F.lit(0)).cast("long").alias("n_changed"))

    def enough(here, all_):
        return (F.col(here) > 0) & ((F.col(here) >= SHARE * F.col(all_)) | (F.col(here) >= LONG))

    by_template = enough("n_windows", "item_windows")
    return found.where(by_template | enough("n_places", "places")).select(
        "k1", "k2", F.col("id").alias(id_col), F.col("item").alias(item_col), F.when(by_template, F.col("n_windows")).otherwise(F.col("n_places")).alias("n_windows"),
        F.when(by_template, F.col("item_windows")).otherwise(F.col("places")).alias("item_windows"), "n_changed")


def without_leaks(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`documents` without those that hold a question."""
    found = leaks(documents, benchmark, id_col, text_col).select("k1", "k2").distinct()
    return nested(documents, *row_keys(id_col, text_col)).join(found, ["k1", "k2"], "left_anti").select(*unnested(documents.schema))


def leaks_sql() -> str:
    """The rule of `leaks` in DuckDB SQL, with the windows themselves in place of their hashes."""
    units, signs = ", ".join(f"'{u}'" for u in UNITS), ", ".join(f"'{u}'" for u in UNITS[:5])
    ends = "'.', '!', '?', ':', chr(10)"

    def words(table, key):
        before = "substring(z[2], 1, 1)"
        digit, mark = "substring(z[1], 1, 1) BETWEEN '0' AND '9'", f"substring(z[1], 1, 1) IN ({ends})"
        unit = f"(lower(z[1]) IN ({signs}) OR (z[2] IS NOT NULL AND {before} BETWEEN '0' AND '9' AND lower(z[1]) IN ({units})))"
        name = f"(z[2] IS NOT NULL AND {before} NOT IN ({ends}) AND lower(substring(z[1], 1, 1)) <> substring(z[1], 1, 1))"
        return f"""SELECT key, list_filter(list_transform(list_zip(raw, list_concat([NULL], raw[:-2])), lambda z: {{'c': CASE WHEN {mark} THEN NULL WHEN {digit} THEN '{NUMBER}' WHEN {unit} THEN '{UNIT}'
 WHEN {name} THEN '{NAME}' ELSE lower(z[1]) END, 'v': CASE WHEN {digit} OR {unit} OR {name} THEN lower(z[1]) END, 'low': lower(z[1])}}), lambda w: w.c IS NOT NULL) AS t
 FROM (SELECT key, regexp_extract_all(coalesce(text, ''), '{_TOKEN.replace(chr(92) + "n", chr(10))}') AS raw FROM (SELECT DISTINCT {key} AS key, text FROM {table}))"""

    windows = f"unnest(range(1, greatest(len(t) - {WORDS - 2}, 2))) AS place"
    lists = "list_transform(p, lambda w: w.c) AS c, list_transform(p, lambda w: w.low) AS low, list_transform(p, lambda w: w.v) AS v"
    same_item = "IS NOT DISTINCT FROM"
    return f"""WITH q AS ({words("benchmark", "item_id")}), d AS MATERIALIZED (SELECT row_number() OVER () AS rid, key, t FROM ({words("documents", "doc_id")})),
qw AS (SELECT DISTINCT item, place, {lists}, len(list_filter(p, lambda w: w.v IS NULL)) >= least({LITERALS}, len(p)) AS telling
 FROM (SELECT key AS item, place, list_slice(t, place, place + {WORDS - 1}) AS p FROM (SELECT key, t, {windows} FROM q WHERE len(t) > 0))),
qc AS (SELECT item, count(DISTINCT place) FILTER (WHERE telling) AS n, count(DISTINCT place) AS places FROM qw GROUP BY item),
qn AS MATERIALIZED (SELECT qw.*, n, places FROM qw JOIN qc ON qw.item {same_item} qc.item),
dw AS MATERIALIZED (SELECT rid, spot, {lists} FROM (SELECT rid, place AS spot, list_slice(t, place, place + {WORDS - 1}) AS p FROM (SELECT rid, t, {windows} FROM d WHERE len(t) > 0))),
th AS MATERIALIZED (SELECT DISTINCT rid, item, place, n, places, dw.c AS kinds, qn.v AS old, dw.v AS new, spot - place AS shift FROM dw JOIN qn ON dw.c = qn.c WHERE telling),
rh AS (SELECT DISTINCT rid, item, place, n, places FROM dw JOIN qn ON dw.low = qn.low),
slots AS (SELECT DISTINCT rid, item, shift, unnest(list_zip(kinds, old, new)) AS s FROM th),
vals AS (SELECT rid, item, shift, s[1] AS kind, s[2] AS old, count(DISTINCT s[3]) AS c, max((s[2] <> s[3])::int) AS other FROM slots WHERE s[2] IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
ok AS (SELECT rid, item, shift, sum(CASE WHEN c = 1 THEN other ELSE 0 END) AS n_changed, list(kind || old) FILTER (WHERE c > 1) AS torn FROM vals GROUP BY 1, 2, 3),
kept AS (SELECT th.rid, th.item, place, n, places, n_changed, true AS by_kind FROM th LEFT JOIN ok ON th.rid = ok.rid AND th.item {same_item} ok.item AND th.shift = ok.shift
 WHERE torn IS NULL OR NOT list_has_any(list_transform(list_filter(list_zip(kinds, old), lambda z: z[2] IS NOT NULL), lambda z: z[1] || z[2]), torn)),
f AS (SELECT rid, item, count(DISTINCT place) FILTER (WHERE by_kind) AS here, max(n) AS n, count(DISTINCT place) AS there, max(places) AS places,
 coalesce(max(n_changed), 0)::bigint AS n_changed FROM (SELECT * FROM kept UNION ALL SELECT rid, item, place, n, places, NULL, false FROM rh) GROUP BY 1, 2),
g AS (SELECT *, here > 0 AND (here >= {SHARE} * n OR here >= {LONG}) AS by_template FROM f)
SELECT d.key AS doc_id, item AS item_id, CASE WHEN by_template THEN here ELSE there END AS n_windows, CASE WHEN by_template THEN n ELSE places END AS item_windows, n_changed
FROM g JOIN d ON g.rid = d.rid WHERE by_template OR there >= {SHARE} * places OR there >= {LONG}"""
