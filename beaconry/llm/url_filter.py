"""URL rules, and a character language-model ratio for URLs that no rule fits.

Two Markov models of variable order (three symbols, backing off to two, one and none by Witten-Bell
weights) are trained on the URLs that the rules allow and on those they block. A URL's score is the
mean difference of log-likelihoods per symbol; the threshold is the one with the best balanced accuracy
on rule-judged URLs that were held back from training (three sixteenths, by the MD5 of the URL).

Symbols: letters without case, digits as one, ten signs, one for all else, start and end: 40, so there
are at most 64,000 triples, which is the proven bound of the table that is broadcast. Log-likelihoods are
kept as whole millionths, so sums do not depend on the order of rows. DataFrame functions only.

Defined cases: a null url counts as an empty one; without `://` host and path are empty; a url with an
empty path fits no rule with a path; if only one kind of rule-judged URL was held back, the threshold is 0;
repeated rows are judged alike and count in training as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (rule, allowed)
RULES = (("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False))
SYMBOLS = 40
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url")))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def folded(url: Column) -> Column:
    """Symbols of a URL between two starts and an end."""
    text = F.translate(F.coalesce(url, F.lit("")), _UPPER + "123456789", _LOWER + "000000000")
    return F.concat(F.lit("^^"), F.regexp_replace(text, r"[^a-z0./:?=&%_-]", "*"), F.lit("$"))


def triples(urls: DataFrame) -> DataFrame:
    """One row per symbol of `symbols` with the two before it."""
    steps = F.expr("transform(sequence(1, length(symbols) - 2), i -> substring(symbols, i, 3))")
    return urls.withColumn("gram", F.explode(steps))


def _order(grams: DataFrame, context: Column, symbol: Column, lower: DataFrame | None) -> DataFrame:
    """Witten-Bell estimates of one order: probability of `symbol` after `context`, per class."""
    counts = grams.groupBy(context.alias("context"), symbol.alias("symbol")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    totals = counts.groupBy("context").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"),
        F.sum((F.col("good") > 0).cast("long")).alias("t_good"), F.sum((F.col("bad") > 0).cast("long")).alias("t_bad"))
    rows = counts.join(totals, "context")
    if lower is None:
        rows = rows.withColumns({"l_good": F.lit(1.0 / SYMBOLS), "l_bad": F.lit(1.0 / SYMBOLS)})
    else:
        rows = rows.withColumn("shorter", F.concat(F.expr("substring(context, 2)"), "symbol")).join(
            lower.select(F.concat("context", "symbol").alias("shorter"), F.col("p_good").alias("l_good"), F.col("p_bad").alias("l_bad")), "shorter")

    def mixed(k):
        n, t = F.col(f"n_{k}"), F.col(f"t_{k}")
        return F.when(n + t == 0, F.col(f"l_{k}")).otherwise((F.col(k) + t * F.col(f"l_{k}")) / (n + t)).alias(f"p_{k}")

    return rows.select("context", "symbol", mixed("good"), mixed("bad"))


def log_ratios(urls: DataFrame) -> DataFrame:
    """(gram, ratio): difference of log-likelihoods in millionths, for every triple in any URL.

    urls: symbols, n (rows with this URL), good and bad (1 if it trains that model)."""
    grams = triples(urls).groupBy("gram").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("bad")).alias("bad"))
    last = F.expr("substring(gram, 3, 1)")
    one = _order(grams, F.expr("substring(gram, 1, 0)"), last, None)
    two = _order(grams, F.expr("substring(gram, 2, 1)"), last, one)
    three = _order(grams, F.expr("substring(gram, 1, 2)"), last, two)
    return three.select(F.concat("context", "symbol").alias("gram"),
                        F.round((F.log("p_good") - F.log("p_bad")) * 1_000_000).cast("long").alias("ratio"))


def threshold(scored: DataFrame) -> int:
    """Hundredths of a nat from which a URL is allowed; at most a few thousand bins come to the window.

    scored: bin, n, good, bad of held-back URLs."""
    bins = scored.groupBy("bin").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("bad")).alias("bad"))
    line = Window.orderBy("bin")
    every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = line.rowsBetween(Window.unboundedPreceding, -1)
    rows = bins.select("bin", F.sum("good").over(every).alias("all_good"), F.sum("bad").over(every).alias("all_bad"),
                       F.coalesce(F.sum("good").over(below), F.lit(0)).alias("good_below"), F.coalesce(F.sum("bad").over(below), F.lit(0)).alias("bad_below"))
    quality = (F.col("all_good") - F.col("good_below")) * F.col("all_bad") + F.col("bad_below") * F.col("all_good")
    best = rows.where("all_good > 0 and all_bad > 0").orderBy(quality.desc(), F.abs("bin"), "bin").first()
    return best["bin"] if best else 0


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Per row: id, host, path, rule, verdict, and the model's mean log ratio in millionths."""
    rows = pages.select(id_col, F.coalesce(F.col(url_col), F.lit("")).alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumn("host", host).withColumn("path", path).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    allowed = [r for r, ok in rules if ok]
    allow = F.col("rule").isin(allowed) if allowed else F.lit(False)
    urls = rows.groupBy("url").agg(F.count("*").alias("n"), F.first("rule").alias("rule"))
    urls = urls.withColumns({
        "symbols": folded(F.col("url")), "held": F.substring(F.md5("url"), 1, 1).isin("0", "1", "2"),
        "is_good": F.coalesce(allow, F.lit(False)).cast("int"), "is_bad": F.coalesce(~allow, F.lit(False)).cast("int")})
    training = urls.withColumns({k: F.when(F.col("held"), 0).otherwise(F.col(f"is_{k}")) for k in ("good", "bad")})
    ratios = log_ratios(training.select("symbols", "n", "good", "bad"))
    # At most SYMBOLS ** 3 rows: broadcast whatever the planner's limit.
    scores = triples(urls.select("url", "symbols")).join(F.broadcast(ratios), "gram").groupBy("url").agg(
        F.floor(F.sum("ratio") / F.count("*")).cast("long").alias("score"))
    marked = urls.join(scores, "url").select("url", "n", "held", F.col("is_good").alias("good"), F.col("is_bad").alias("bad"), "score",
                                             F.floor(F.col("score") / 10_000).cast("long").alias("bin"))
    limit = threshold(marked.where("held and good + bad > 0"))
    by_model = F.when(F.col("bin") >= limit, "allow").otherwise("block")
    verdict = F.when(F.col("rule").isNull(), by_model).when(allow, "allow").otherwise("block")
    return rows.join(marked.select("url", "score", "bin"), "url").select(
        id_col, "host", "path", "rule", verdict.alias("verdict"), "score")


def judge_sql(rules=RULES) -> str:
    """The same on table `pages` in DuckDB SQL."""
    cases = " ".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
                     for r, _ in sorted(rules, key=lambda r: -len(r[0])))
    good = ", ".join(f"'{r}'" for r, ok in rules if ok)

    def order(name, context, lower):
        low = f"JOIN {lower} l ON l.context || l.symbol = substring(c.context, 2) || c.symbol" if lower else ""
        prior = "l.p_{0}" if lower else f"(1.0::double / {SYMBOLS})"
        mixed = ", ".join(f"CASE WHEN n_{k} + t_{k} = 0 THEN {prior.format(k)} ELSE (c.{k} + t_{k} * {prior.format(k)}) / (n_{k} + t_{k}) END AS p_{k}" for k in ("good", "bad"))
        return f"""{name}_c AS (SELECT {context} AS context, substring(gram, 3, 1) AS symbol, sum(good)::double AS good, sum(bad)::double AS bad FROM grams GROUP BY 1, 2),
{name}_t AS (SELECT context, sum(good) AS n_good, sum(bad) AS n_bad, (count(*) FILTER (good > 0))::double AS t_good, (count(*) FILTER (bad > 0))::double AS t_bad FROM {name}_c GROUP BY 1),
{name} AS (SELECT c.context, c.symbol, {mixed} FROM {name}_c c JOIN {name}_t t ON c.context = t.context {low})"""

    return f"""WITH parts AS (SELECT page_id, coalesce(url, '') AS url,
 CASE WHEN contains(coalesce(url, ''), '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
judged AS (SELECT *, CASE {cases} END AS rule FROM split),
urls AS (SELECT url, count(*) AS n, first(rule) AS rule FROM judged GROUP BY url),
folded AS (SELECT url, n, '^^' || regexp_replace(translate(url, '{_UPPER}123456789', '{_LOWER}000000000'), '[^a-z0./:?=&%_-]', '*', 'g') || '$' AS symbols,
 substring(md5(url), 1, 1) IN ('0', '1', '2') AS held, (rule IS NOT NULL AND rule IN ({good}))::int AS good, (rule IS NOT NULL AND rule NOT IN ({good}))::int AS bad FROM urls),
steps AS (SELECT url, n, held, good, bad, unnest(list_transform(range(1, length(symbols) - 1), lambda i: substring(symbols, i, 3))) AS gram FROM folded),
grams AS (SELECT gram, sum(CASE WHEN held THEN 0 ELSE n * good END) AS good, sum(CASE WHEN held THEN 0 ELSE n * bad END) AS bad FROM steps GROUP BY gram),
{order("o1", "''", None)},
{order("o2", "substring(gram, 2, 1)", "o1")},
{order("o3", "substring(gram, 1, 2)", "o2")},
ratios AS (SELECT context || symbol AS gram, round((ln(p_good) - ln(p_bad)) * 1000000)::bigint AS ratio FROM o3),
scores AS (SELECT url, floor(sum(ratio)::double / count(*))::bigint AS score FROM steps JOIN ratios USING (gram) GROUP BY url),
marked AS (SELECT f.url, f.n, f.held, f.good, f.bad, score, floor(score::double / 10000)::bigint AS bin FROM folded f JOIN scores USING (url)),
bins AS (SELECT bin, sum(n * good) AS good, sum(n * bad) AS bad FROM marked WHERE held AND good + bad > 0 GROUP BY bin),
lines AS (SELECT bin, sum(good) OVER () AS all_good, sum(bad) OVER () AS all_bad,
 coalesce(sum(good) OVER w, 0) AS good_below, coalesce(sum(bad) OVER w, 0) AS bad_below FROM bins WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT bin FROM lines WHERE all_good > 0 AND all_bad > 0
 ORDER BY (all_good - good_below) * all_bad + bad_below * all_good DESC, abs(bin), bin LIMIT 1), 0) AS bin)
SELECT page_id, host, path, j.rule AS rule, CASE WHEN j.rule IS NULL THEN CASE WHEN m.bin >= (SELECT bin FROM best) THEN 'allow' ELSE 'block' END
 WHEN j.rule IN ({good}) THEN 'allow' ELSE 'block' END AS verdict, m.score AS score FROM judged j JOIN marked m ON j.url = m.url"""
