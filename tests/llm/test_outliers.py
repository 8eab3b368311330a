import random
import re

import numpy as np

from beaconry.llm import outliers as ol

SPACE = " \t\n\v\f\r"


def plain(text):
    words, lines, seen = re.findall(r"[^\x20\x09-\x0D]+", text or ""), 0, []
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            lines += line in seen
            seen.append(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(inside)


def test_statistics():
    rng = random.Random(8)
    texts = [None, "", " \n ", "a b c", "x\x85y   z\x1cq", "one two\none two\n\n \none two", "a " * 40, "#%& $ <b> |*"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a ", "b\n", "é#", "word\t", "a b c d e f g h ", "\v"]) for _ in range(rng.randint(0, 120))))
    for t in texts:
        assert ol.text_statistics(t) == plain(t)


def make(spark, n=400):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(60, 200))]
        rows.append((i, " ".join(words), "en" if i % 3 else "de", "big" if i % 2 else "other"))
    rows += [(n, " ".join("%#" * 9 + str(k) for k in range(90)), "en", "big"), (n + 1, None, None, None), (n + 2, "a b", "en", "big"),
             (n + 3, "s " * 50, "en", "big"), (n + 4, rows[0][1], None, "big"), (n + 4, rows[0][1], None, "big")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_junk_goes_and_clean_stays(spark):
    rows, df = make(spark)
    got = {r.doc_id: r for r in ol.judged(df.withColumn("g", df.doc_id).withColumn("id", df.doc_id)).collect()}
    for i, text, _, _ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert not got[400].kept and not got[400].base_failed and got[404].kept
    assert sum(not got[i].kept for i in range(400)) <= 4
    assert got[401].base_failed and got[401].distance is None


def test_estimate_resists_a_third_of_outliers(spark):
    rng = np.random.default_rng(0)
    clean = rng.normal(0, 1, (2000, 5))
    bad = rng.normal(9, 0.1, (900, 5))
    rows = [("x", *map(float, v)) for v in np.vstack([clean, bad])] + [("y", *([1.0] * 5))] * 70
    model = {r.g: r for r in ol.minimum_covariance_determinant(
        spark.createDataFrame(rows, "g string, v0 double, v1 double, v2 double, v3 double, v4 double")).collect()}
    assert np.abs(np.array(model["x"].center)).max() < 0.25 and model["x"].n == 2900
    assert model["y"].center == [1.0] * 5 and model["y"].n == 70
    # Brute force: another step with sorted distances does not lower the determinant, nor do steps from the medians alone end lower.
    data, floor = np.vstack([clean, bad]), np.diag(np.square(ol.FLOORS))

    def step(center, cov):
        d = np.einsum("ij,jk,ik->i", data - center, np.linalg.inv(cov), data - center)
        half = data[np.argsort(d)[:len(data) // 2]]
        return half.mean(0), np.cov(half.T, bias=True) + floor

    r = model["x"]
    found = np.reshape(r.cov, (5, 5))
    assert abs(np.linalg.slogdet(found)[1] - r.logdet) < 1e-6
    assert np.linalg.slogdet(step(np.array(r.center), found)[1])[1] > r.logdet - 0.03   # a bin of equal distances is taken whole
    center, cov = np.median(data, 0), np.diag(np.square(1.4826 * np.median(np.abs(data - np.median(data, 0)), 0))) + floor
    for _ in range(30):
        center, cov = step(center, cov)
    assert r.logdet < np.linalg.slogdet(cov)[1] + 0.05
    d = np.einsum("ij,jk,ik->i", data - r.center, np.linalg.inv(found), data - r.center)
    assert abs(np.median(d) / ol.MEDIAN - r.scale) < 0.01 * r.scale


def test_small_groups_borrow_from_the_one_above(spark):
    eye, cells = np.eye(5).ravel().tolist(), "g string, n long, center array<double>, cov array<double>, scale double"
    model = spark.createDataFrame([("c", 5000, [0.0] * 5, eye, 1.0), ("b=en", 450, [1.0] * 5, eye, 2.0), ("a=en/=x", 50, [3.0] * 5, eye, 0.5)], cells)
    parents = spark.createDataFrame([("c", "c", 0), ("b=en", "c", 1), ("a=en/=x", "b=en", 2)], "g string, parent string, level int")
    (got,) = ol.pooled(model, parents).collect()

    def mixed(n, center, cov, above):
        a = n / (n + ol.POOL)
        gap = np.array(center) - above[0]
        return a * np.array(center) + (1 - a) * above[0], a * cov + (1 - a) * above[1] + a * (1 - a) * np.outer(gap, gap)

    top = mixed(5000, [0.0] * 5, np.eye(5), (np.zeros(5), ol.PRIOR * np.eye(5)))
    low = mixed(50, [3.0] * 5, np.eye(5), mixed(450, [1.0] * 5, 2 * np.eye(5), top))
    assert got.g == "a=en/=x" and np.allclose(got.center, low[0]) and np.allclose(np.reshape(got.cov, (5, 5)), low[1])
    assert np.allclose(np.reshape(got.inverse, (5, 5)) @ low[1], np.eye(5), atol=1e-6)


def test_empty(spark):
    assert ol.judged(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).collect() == []
