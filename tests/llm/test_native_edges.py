import duckdb

import corpus_pipeline
from beaconry.llm import decontamination as dc
from beaconry.llm import tool_calls as tc
from beaconry.llm import url_filter as uf


def test_hosts_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1?x=/q#f", "https://example.org/en/12", "x://org/", "x://org", "x://notorg/", "a://b.com/fr/x",
            "a://b.com/de/x://y", "a://b.com:80/de/", "a://c.net/" + "é" * 5000, "a://b.com/fr/x"]
    df = spark.createDataFrame([(i, u, "p") for i, u in enumerate(urls)], "page_id long, url string, path string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in uf.judge(df).orderBy("page_id").collect()]
    assert [g[:2] for g in got[:3]] == [("", "")] * 3
    assert got[3] == ("a.example.org", "/es/1", "example.org/es/", "block") and got[4] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("org", "/", "org/", "allow") and got[6][:3] == ("org", "", None) and got[7][2] is None
    assert got[8] == got[12] == ("b.com", "/fr/x", "com/fr/", "allow") and got[9][1:] == ("/de/x://y", "com/de/", "block")
    assert got[10][2] is None and len(got) == len(urls) and {g[3] for g in got} == {"allow", "block"}
    assert uf.judge(df.limit(0)).collect() == []


QUESTION = "A train leaves the small town and travels 60 km in 2 hours. How fast does Anna see it go past her old house?"


def test_other_numbers_are_caught_if_they_are_consistent(spark):
    same = QUESTION.replace("60", "75").replace("2 hours", "3 hours").replace("Anna", "Bert")
    rows = [(1, f"Intro words here. {QUESTION} And more."), (2, same), (2, same), (3, "A train leaves. Nothing else is said."), (4, None), (5, ""),
            (None, QUESTION), (6, " ".join([QUESTION] * 300))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(9, QUESTION), (10, "Short one"), (11, None), (12, "5 5 5 5 5 5")], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.item_id, r.n_changed) for r in dc.leaks(docs, bench).collect())
    assert got == [(0, 9, 0), (1, 9, 0), (2, 9, 3), (6, 9, 0)]
    kept = dc.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    twice = "Tom has 4 red apples and gives 4 red apples to his sister Mia today"
    bad = twice.replace("4", "5", 1)   # one value of the question has become two
    pair = spark.createDataFrame([(1, bad), (2, twice.replace("4", "7"))], "doc_id long, text string")
    assert [r.doc_id for r in dc.leaks(pair, spark.createDataFrame([(1, twice)], "item_id long, text string")).collect()] == [2]
    assert dc.leaks(docs.limit(0), bench).collect() == [] and dc.leaks(docs, bench.limit(0)).collect() == []


def test_verbatim_copies_whatever_they_consist_of(spark):
    sums, names = "12 + 7 = 19, 3 x 4 = 12, 8 - 5 = 3", "Ask Anna Berg, Carl Dorn, Eva Frey, Gerd Hahn or Ida Jung about Kurt Lang"
    plain = " ".join(f"w{chr(97 + i)}x" for i in range(22))
    torn = f"Put 40 here then {plain} and take 40 away at once"   # one of two equal numbers differs
    bench = spark.createDataFrame([(1, sums), (2, names), (3, QUESTION), (None, QUESTION), (4, torn)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"See: {sums}."), (2, names.lower()), (3, QUESTION.upper()), (4, torn.replace("40", "41", 1)),
                                  (5, "12 7 19 and no more"), (6, sums.replace("7", "6").replace("3", "9"))], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id or 0) for r in dc.leaks(docs, bench).collect())
    assert got == [(1, 1), (2, 2), (3, 0), (3, 3), (4, 4)]
    assert sorted(r.doc_id for r in dc.without_leaks(docs, bench).collect()) == [5, 6]


def test_sql_has_the_same_rule(spark):
    """Names only, torn values, null items and ids, short questions, equal rows: rows of the query and of its SQL."""
    sums, names = "12 + 7 = 19, 3 x 4 = 12, 8 - 5 = 3", "Ask Anna Berg, Carl Dorn, Eva Frey, Gerd Hahn or Ida Jung about Kurt Lang"
    torn = "Put 40 here then " + " ".join(f"w{chr(97 + i)}x" for i in range(22)) + " and take 40 away at once"
    bench = [(1, sums), (2, names), (3, QUESTION), (None, QUESTION), (4, torn), (5, "Short one"), (6, None), (7, "5 5 5 5 5 5"), (3, QUESTION), (8, "")]
    docs = [(1, f"See: {sums}."), (2, names.lower()), (3, QUESTION.upper()), (4, torn.replace("40", "41", 1)), (4, torn.replace("40", "41")), (5, "short one"), (6, None),
            (7, ""), (8, "5 5 5 5 5 5 5"), (None, QUESTION), (9, QUESTION.replace("60", "75").replace("Anna", "Bert")), (9, QUESTION.replace("60", "75").replace("Anna", "Bert")),
            (10, "short one more"), (11, f"{QUESTION} {torn} {QUESTION.replace('2', '3')}"), (12, torn.replace("wax", "wbx"))]
    got = dc.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).drop("k1", "k2").collect()
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", bench)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    order = lambda rows: sorted(map(tuple, rows), key=repr)
    assert order(got) == order(con.execute(dc.leaks_sql()).fetchall()) and len(got) > 10


def test_calls(spark):
    calls = spark.createDataFrame([
        (1, "a", None, "add", '{"y": 2, "x": "1", "z": true}'), (1, "b", "a", "add", '{"x": 1}'), (1, "c", "b", "add", "broken"), (1, "d", "c", "none", "{}"),
        (1, "a", None, "add", '{"y": 2, "x": "1", "z": true}'), (2, "p", "q", "add", '{"x":1,"y":2}'), (2, "q", "p", "add", '{"x":1,"y":2}'),
        (3, "k", "lost", "add", '{"x":1,"y":2.5}'), (3, "m", None, "add", '{"y":4,"x":3}'), (4, "n", None, "add", None)],
        "conv long, call string, after string, name string, arguments string")
    results = spark.createDataFrame([(1, "a", "é\n\"3\""), (1, "a", "é\n\"3\""), (3, "m", "7"), (3, "m", "6"), (9, "x", "stray"), (1, None, "?")], "conv long, call string, content string")
    schemas = spark.createDataFrame([("add", "x", "integer", True), ("add", "y", "integer", True)], "name string, param string, kind string, required boolean")
    got = {(r.conv, r.call): r for r in tc.link(calls, results, schemas).collect()}
    assert len(got) == 9
    assert [got[1, c].step for c in "abcd"] == [0, 1, 2, 3] and got[2, "p"].step is None and got[3, "k"].step == 0
    assert {k: r.problem for k, r in got.items()} == {
        (1, "a"): "not integer x", (1, "b"): "missing y", (1, "c"): "arguments", (1, "d"): "unknown tool", (2, "p"): "cycle", (2, "q"): "cycle",
        (3, "k"): "not integer y", (3, "m"): None, (4, "n"): "arguments"}
    assert got[3, "m"].line == '{"arguments":{"x":3,"y":4},"id":"m","name":"add","result":"6"}' and got[3, "m"].n_results == 2
    assert got[1, "a"].line.endswith('"result":"é\\n\\"3\\""}')


def test_calls_have_types_and_clashes_are_told(spark):
    schemas = spark.createDataFrame([("f", "q", "string", True), ("f", "n", "integer", False), ("f", "x", "number", False), ("f", "b", "boolean", False),
                                     ("f", "o", "object", False), ("f", "l", "array", False)], "name string, param string, kind string, required boolean")
    given = {
        '{"q":"a","n":7,"x":1.50,"b":true}': (None, '{"b":true,"n":7,"q":"a","x":1.5}'), '{"query":5,"q":"a"}': ("surplus query", '{"q":"a","query":5}'),
        '{"q":5}': ("not string q", '{"q":5}'), '{"q":"a","n":"7"}': ("not integer n", '{"n":"7","q":"a"}'), '{"q":"a","b":"true"}': ("not boolean b", '{"b":"true","q":"a"}'),
        '{"q":{"b":1,"a":2}}': ("not string q", '{"q":{"a":2,"b":1}}'), '{"q":"a","q":"b"}': ("arguments", "{}"), "[1]": ("arguments", "{}"), None: ("arguments", "{}"),
        '{"q":"a","o":{"z":{"y":1,"x":[{"d":1,"c":2}]}},"l":[]}': (None, '{"l":[],"o":{"z":{"x":[{"c":2,"d":1}],"y":1}},"q":"a"}'),
        '{"q":null}': ("missing q", '{"q":null}'), ' { "q" : "é\\n" } ': (None, '{"q":"é\\n"}'), '{"q":"a","n":1.5}': ("not integer n", '{"n":1.5,"q":"a"}')}
    calls = spark.createDataFrame([(1, f"c{i:02}", None, "f", a, "x") for i, a in enumerate(given)], "conv long, call string, after string, name string, arguments string, row string")
    results = spark.createDataFrame([(1, f"c{i:02}", "r") for i in range(len(given))], "conv long, call string, content string")
    got = [(r.problem, r.line) for r in tc.link(calls, results, schemas).orderBy("call").collect()]
    assert got == [(p, f'{{"arguments":{body},"id":"c{i:02}","name":"f","result":"r"}}') for i, (p, body) in enumerate(given.values())]
    odd = spark.createDataFrame([(None, "a", None, "f", '{"q":"1"}'), (None, "b", "a", "f", '{"q":"1"}'), (1, None, None, "f", '{"q":"1"}'), (1, None, None, "f", '{"q":"1"}'),
                                 (2, "a", None, "f", '{"q":"1"}'), (2, "a", None, "f", '{"q":"2"}'), (2, "b", "a", None, '{"q":"1"}')], "conv long, call string, after string, name string, arguments string")
    answers = spark.createDataFrame([(None, "a", "r"), (None, "b", "r"), (1, None, "?"), (2, "a", "r")], "conv long, call string, content string")
    rows = sorted((r.conv or 0, r.call or "", r.step, r.problem or "", r.n_results) for r in tc.link(odd, answers, schemas).collect())
    assert rows == [(0, "a", 0, "", 1), (0, "b", 1, "", 1), (1, "", 0, "no result", 0), (2, "a", 0, "clash", 1), (2, "a", 0, "clash", 1), (2, "b", 1, "unknown tool", 0)]
    assert tc.link(odd.limit(0), answers, schemas).collect() == []


def test_pipeline(spark):
    """Stages on a small table: what goes, what stays, and that the pieces cover what stayed."""
    data = "/root/testdata/sf0.001"
    docs = corpus_pipeline.read_table(spark, data, "documents")
    columns, sizes = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, data), "stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[1] >= sizes[0] - 3 and sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.8 * sizes[0]
    pieces = corpus_pipeline.run(spark, data).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
