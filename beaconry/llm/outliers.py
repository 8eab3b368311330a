"""Quality rules: fixed rules first, then robust multivariate outliers per language and source.

Of every document that passes the fixed rules a vector of transformed statistics is taken. For each
language and source, each language, and all documents the minimum-covariance-determinant estimate is
searched over all their documents: from three starts, concentration steps replace mean and covariance by
those of the half with the smallest distances; the start with the smallest determinant goes on until the
steps lower it no more. A document whose squared Mahalanobis distance is beyond the chi-square quantile is rejected.

A step is one scan that sums moments per bin of distances; a group is never sorted. The estimate that judges is that of a
mixture: the n documents of the language and source with `POOL` documents of the language, which in turn is mixed
with all documents, and these with a fixed wide `PRIOR`. So a small group is judged mostly by its language, by one
formula for every size.

Defined cases: null text has no words and fails the fixed rules; null language or source is a group
like any other; statistics that hardly vary get a floor, so that no covariance is singular; equal rows are
judged alike; columns of any name may stand beside; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, stored

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = ("v0", "v1", "v2", "v3", "v4")
#: Smallest standard deviation a transformed statistic is taken to have.
FLOORS = (0.3, 0.08, 0.08, 0.08, 0.05)
WINDOW, SALTS, BINS = 8, 16, 200
#: Steps from every start; least fall of the determinant's logarithm that calls for another step.
FIRST, GAIN = 2, 1e-3
#: Documents that a group borrows from the one above it; variance of the uppermost, of all statistics.
POOL, PRIOR = 50, 1.0
#: Squared distance: the chi-square quantile of 5 degrees at 1e-4, and its median.
CUT, MEDIAN = 25.745, 4.351
_SYMBOL = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def text_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines, words in repeated 8-word windows."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    n = len(words)
    chars = len(text) - len(re.findall(r"[\x20\x09-\x0D]", text))
    symbols = len(_SYMBOL.findall(text)) if _SYMBOL.search(text) else 0
    lines, seen = 0, set()
    if "\n" in text:
        for line in text.split("\n"):
            if line in seen:
                lines += 1
            elif _WORD.search(line):
                seen.add(line)
    return n, chars, symbols, lines, repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of 8 words that occur twice or more; exact, by doubling the length named."""
    n = len(words)
    if n < WINDOW + 1:
        return 0
    numbers: dict[bytes, int] = {}
    name = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    for step in (1, 2, 4):
        pair = name[:-step] * np.int64(n + 1) + name[step:]
        kinds, name, counts = np.unique(pair, return_inverse=True, return_counts=True)
        if len(kinds) == len(pair):
            return 0
    start = np.flatnonzero(counts[name] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def statistics(documents: DataFrame, keep: tuple, text_col: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            last = batch.num_columns - 1
            rows = [text_statistics(t) for t in batch.column(last).to_pylist()]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], *(pa.array(c, pa.int64()) for c in columns)],
                                             names=[*batch.schema.names[:last], *STATISTICS])

    picked = documents.select(*keep, text_col)
    schema = documents.select(*keep).schema
    for name in STATISTICS:
        schema = schema.add(name, "long")
    return arrow_map(picked, work, schema)


def _vectors(rows: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "v0": F.log1p(F.col("n_words").cast("double")),
        "v1": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "v2": F.log1p(10.0 * F.col("n_symbols") / words),
        "v3": F.log1p(F.col("n_dup_lines").cast("double")),
        "v4": F.sqrt(F.col("n_repeat_words") / words)})


_COLUMNS = ["g", "k", "n", "center", "cov", "inverse", "logdet"]
_MODEL = "g string, k int, n long, center array<double>, cov array<double>, inverse array<double>, logdet double"
_PAIRS = [(i, j) for i in range(5) for j in range(i, 5)]


def _row(g, k, n, center, cov) -> tuple:
    """A row of `_MODEL`; the floors go on top of the covariance, digits that depend on the order of sums are cut."""
    cov = np.round(cov, 12)
    return g, k, n, list(map(float, center)), cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _square(r: dict, prefix: str) -> np.ndarray:
    return np.array([[r[f"{prefix}{min(i, j)}_{max(i, j)}"] for j in range(5)] for i in range(5)])


def _models(rows: DataFrame, work) -> DataFrame:
    """`work(record)` gives the model rows of each row; records are one per group and start."""
    def run(frames):
        import pandas as pd
        for frame in frames:
            yield pd.DataFrame([m for r in frame.to_dict("records") for m in work(r)], columns=_COLUMNS)

    return rows.mapInPandas(run, _MODEL)


def _beside(rows: DataFrame, model: DataFrame, how: str = "inner") -> DataFrame:
    """Rows (g, s and the vector) next to their group's row; a group with most of the rows is dealt over its salts s."""
    return rows.join(model.withColumn("s", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)"))), ["g", "s"], how)


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("s", F.monotonically_increasing_id() % SALTS)


def _distance():
    d = [F.col(v) - F.col("center")[i] for i, v in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i in range(5):
        for j in range(5):
            total = total + d[i] * d[j] * F.col("inverse")[5 * i + j]
    return total


def _bin(distance):
    """Squared distances in bins that are half a percent wide, `BINS` to an e-fold."""
    return F.floor(F.log(F.greatest(distance, F.lit(1e-6))) * BINS).cast("long")


def _half(bins: DataFrame) -> DataFrame:
    """(g, k, h, t) of counted `bins` (g, k, b, n): the bin h in which half of the t rows is reached.

    First among blocks of 64 bins, then inside the block that holds it, so a window never sees more than
    about 90 rows of a group, however many bins and rows it has."""
    blocks = bins.groupBy("g", "k", F.floor(F.col("b") / 64).alias("c")).agg(F.sum("n").alias("n"))
    upto, whole = Window.partitionBy("g", "k").orderBy("c"), Window.partitionBy("g", "k")
    blocks = blocks.withColumns({"u": F.sum("n").over(upto), "t": F.sum("n").over(whole)})
    block = blocks.where("u * 2 >= t and (u - n) * 2 < t").select("g", "k", "c", "t", (F.col("u") - F.col("n")).alias("before"))
    inside = bins.withColumn("c", F.floor(F.col("b") / 64)).join(block, ["g", "k", "c"])
    inside = inside.withColumn("u", F.col("before") + F.sum("n").over(Window.partitionBy("g", "k").orderBy("b")))
    return inside.where("u * 2 >= t").groupBy("g", "k").agg(F.min("b").alias("h"), F.max("t").alias("t"))


def _starts(rows: DataFrame) -> DataFrame:
    """Three starts a group: deviations from the medians as they are, as hyperbolic tangents, as directions."""
    middle = rows.groupBy("g").agg(F.count("*").alias("n"), *(F.percentile_approx(v, 0.5, 2000).alias(f"m{i}") for i, v in enumerate(VECTOR)))
    middle = stored(middle, "middle")
    spread = _beside(rows, middle).groupBy("g").agg(*(
        F.percentile_approx(F.abs(F.col(v) - F.col(f"m{i}")), 0.5, 2000).alias(f"d{i}") for i, v in enumerate(VECTOR)))
    scaled = stored(middle.join(spread, "g"), "middle")
    unit = [(F.col(v) - F.col(f"m{i}")) / (1.4826 * F.col(f"d{i}") + FLOORS[i]) for i, v in enumerate(VECTOR)]
    z = _beside(rows, scaled).select("g", *(u.alias(f"z{i}") for i, u in enumerate(unit)))
    length = F.greatest(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(5)), F.lit(0.0)), F.lit(1e-12))
    z = z.select("g", *(F.tanh(f"z{i}").alias(f"h{i}") for i in range(5)), *((F.col(f"z{i}") / F.sqrt(length)).alias(f"u{i}") for i in range(5)))
    cells = [F.avg(f"h{i}").alias(f"h{i}") for i in range(5)]
    cells += [F.avg(F.col(f"{x}{i}") * F.col(f"{x}{j}")).alias(f"{x}{i}_{j}") for x in "hu" for i, j in _PAIRS]

    def work(r):
        sd = np.array([1.4826 * r[f"d{i}"] for i in range(5)])
        floor, center = np.diag(np.square(FLOORS)), [r[f"m{i}"] for i in range(5)]
        tanh = np.array([r[f"h{i}"] for i in range(5)])
        for k, shape in enumerate((np.eye(5), _square(r, "h") - np.outer(tanh, tanh), 5 * _square(r, "u"))):
            yield _row(r["g"], k, r["n"], center, sd[:, None] * shape * sd + floor)

    return stored(_models(scaled.join(z.groupBy("g").agg(*cells), "g"), work), "estimate")


def _concentrated(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Mean and covariance of the half of each group's rows that is nearest to each of its models.

    One scan: moments are summed per bin of distances (partial sums before the shuffle), then the bins up to the half."""
    cells = [F.sum(v).alias(f"s{i}") for i, v in enumerate(VECTOR)]
    cells += [F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"s{i}_{j}") for i, j in _PAIRS]
    names = [f"s{i}" for i in range(5)] + [f"s{i}_{j}" for i, j in _PAIRS]
    near = _beside(rows, model.select("g", "k", "center", "inverse")).withColumn("b", _bin(_distance()))
    bins = stored(near.groupBy("g", "k", "b").agg(F.count("*").alias("n"), *cells), "bins")
    half = bins.join(_half(bins), ["g", "k"]).where("b <= h").groupBy("g", "k").agg(
        F.sum("n").alias("n"), F.max("t").alias("t"), *(F.sum(c).alias(c) for c in names))

    def work(r):
        mean = np.array([r[f"s{i}"] for i in range(5)]) / r["n"]
        yield _row(r["g"], r["k"], r["t"], mean, _square(r, "s") / r["n"] - np.outer(mean, mean) + np.diag(np.square(FLOORS)))

    return stored(_models(half, work), "estimate")


def minimum_covariance_determinant(rows: DataFrame) -> DataFrame:
    """Per group g of `rows` (g, v0..v4): size n, centre, covariance, log determinant, and the scale that brings
    the median squared distance to that of a normal vector.

    `FIRST` concentration steps from every start, then on from the start with the smallest determinant until a step
    no longer lowers its logarithm by `GAIN`. Groups that are done take no part in later steps; as each step lowers
    a number that the floors bound from below, the steps end."""
    rows = _salted(rows.select("g", *VECTOR))
    model = _starts(rows)
    for _ in range(FIRST):
        model = _concentrated(rows, model)
    best = model.groupBy("g").agg(F.min_by(F.struct(*_COLUMNS), F.struct("logdet", "k")).alias("m")).select("m.*")
    active, done = stored(best, "estimate"), []
    while not active.isEmpty():
        after = _concentrated(rows, active)
        beside = active.select(F.col("g"), F.struct(*_COLUMNS).alias("old")).join(after.select(F.col("g"), F.struct(*_COLUMNS).alias("new")), "g")
        beside = beside.withColumn("lower", F.col("new.logdet") < F.col("old.logdet") - GAIN)
        done.append(beside.where("not lower").select("old.*"))
        active = stored(beside.where("lower").select("new.*"), "estimate")
    final = active
    for part in done:
        final = final.unionByName(part)
    final = stored(final, "estimate")
    near = _beside(rows, final.select("g", "k", "center", "inverse")).select("g", "k", _bin(_distance()).alias("b"))
    bins = stored(near.groupBy("g", "k", "b").agg(F.count("*").alias("n")), "bins")
    scale = _half(bins).select("g", (F.exp((F.col("h") + 0.5) / BINS) / MEDIAN).alias("scale"))
    return stored(final.join(scale, "g").select("g", "n", "center", "cov", "logdet", "scale"), "estimate")


def _mixed(own: DataFrame) -> DataFrame:
    """Mean and covariance of n rows of a group (center, cov, scale) and `POOL` rows of its parent (above.center, above.cov)."""
    def work(r):
        share = r["n"] / (r["n"] + POOL)
        center, above = np.array(r["center"]), np.array(r["above_center"])
        cov = np.reshape(r["cov"], (5, 5)) * max(r["scale"], 1.0)
        both = share * cov + (1 - share) * np.reshape(r["above_cov"], (5, 5)) + share * (1 - share) * np.outer(center - above, center - above)
        yield _row(r["g"], 0, r["n"], share * center + (1 - share) * above, both)

    return stored(_models(own.select("g", "n", "center", "cov", "scale", "above_center", "above_cov"), work), "estimate")


def pooled(model: DataFrame, parents: DataFrame) -> DataFrame:
    """The estimates of `model` joined with those of their parents (g, parent, level; the parent of level 0 is the fixed `PRIOR`)."""
    placed = model.join(parents, "g")
    prior = F.array(*(F.lit(PRIOR if i == j else 0.0) for i in range(5) for j in range(5)))
    parts = [_mixed(placed.where("level = 0").withColumns({"above_center": F.col("center"), "above_cov": prior}))]
    for level in (1, 2):
        above = parts[-1].select(F.col("g").alias("parent"), F.col("center").alias("above_center"), F.col("cov").alias("above_cov"))
        parts.append(_mixed(placed.where(F.col("level") == level).join(above, "parent")))
    return parts[-1]


def judged(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           source_col: str = "source") -> DataFrame:
    """Per document: id, the five statistics, base_failed, kept, and the squared distance (null if not judged)."""
    keep = (F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"))
    counted = statistics(documents, keep, text_col)
    counted = counted.withColumn("base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30))
    # Group names: language and source, language, all; null is written so that no text can equal it.
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.regexp_replace(c, "/", "//")), F.lit("-"))
    levels = {"g2": F.concat(F.lit("a"), name("lang"), F.lit("/"), name("source")), "g1": F.concat(F.lit("b"), name("lang")), "g0": F.lit("c")}
    vectors = stored(_vectors(counted.withColumns(levels)).drop("lang", "source"), "statistics")
    good = vectors.where("not base_failed")
    model = minimum_covariance_determinant(good.select(F.explode(F.array("g2", "g1", "g0")).alias("g"), *VECTOR))
    parents = good.select(F.explode(F.array(*(
        F.struct(F.col(f"g{i}").alias("g"), F.col(f"g{max(i - 1, 0)}").alias("parent"), F.lit(i).alias("level")) for i in range(3)))).alias("p"))
    groups = pooled(model, stored(parents.select("p.*").distinct(), "groups")).select("g", "center", "inverse")
    scored = _beside(_salted(vectors.withColumnRenamed("g2", "g")), groups, "left").withColumn("distance", _distance())
    return scored.select(
        F.col("id").alias(id_col), *STATISTICS, "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= CUT, F.lit(True))).alias("kept"),
        F.when(~F.col("base_failed"), F.round("distance", 3)).alias("distance"))
