"""The query language: filters with missing values, nested records, windows, dimensions, errors; and a random model."""

import random

import pytest
from pyspark.sql import functions as F

from driftwell.plans import filters
from driftwell.plans.dimensions import Dimension, expand
from driftwell.plans.paths import drill_filter
from driftwell.plans.query import Engine


@pytest.fixture(scope="module")
def nested(spark):
    schema = "id int, a struct<b:array<struct<c:int,d:string>>, e:int>"
    return spark.createDataFrame([(1, ([(1, "x"), (2, None)], 5)), (2, ([], 6)), (3, (None, 7)), (4, ([(3, "x")], None)), (5, None)], schema)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_two_valued_logic(nested):
    e = Engine(nested.sparkSession, {"t": nested})
    run = lambda w: ids(e.run({"from": "t", "select": ["id"], "where": w}))
    assert run({"not": {"term": {"a.e": 5}}}) == [2, 3, 4, 5]
    assert run({"term": {"a.e": None}}) == [4, 5] == run({"missing": "a.e"})
    assert run({"range": {"a.e": {"gte": 6}}}) == [2, 3] and run({"not": {"range": {"a.e": {">=": 6}}}}) == [1, 4, 5]
    assert run({"terms": {"a.e": [5, None]}}) == [1, 4, 5] and run({"terms": {"a.e": []}}) == []
    assert run({"and": []}) == [1, 2, 3, 4, 5] and run({"or": []}) == []
    assert run({"nested": {"path": "a.b", "query": {"term": {"a.b.d": "x"}}}}) == [1, 4]


def test_simplify():
    s = filters.simplify
    assert s({"and": [{"match_all": {}}, {"and": [{"term": {"a": 1}}, {"term": {"a": 1}}]}]}) == {"term": {"a": 1}}
    assert s({"or": [{"terms": {"a": []}}, {"term": {"b": 2}}]}) == {"term": {"b": 2}}
    assert s({"not": {"not": {"term": {"a": 1}}}}) == {"term": {"a": 1}} and s({"not": {"match_all": {}}}) is False


def test_scripts_are_limited():
    for bad in ("java_method('x', 'y')", "(select 1)", "reflect('a','b')", "1; drop table x"):
        with pytest.raises(ValueError):
            filters.script(bad)


def test_nested_selection(nested):
    e = Engine(nested.sparkSession, {"t": nested})
    assert sorted((r["c"] is None, r["c"] or 0) for r in e.run({"from": "t", "select": "a.b.c"}).collect()) == [(False, 1), (False, 2), (False, 3), (True, 0), (True, 0)]
    assert sorted((r["id"], r["c"] or 0) for r in e.run({"from": "t", "select": ["id", "a.b.c"]}).collect()) == [(1, 1), (1, 2), (2, 0), (3, 0), (4, 3), (5, 0)]
    flat = drill_filter(nested, {"and": [{"term": {"a.b.d": "x"}}, {"range": {"id": {"lt": 4}}}]})
    assert [(r[0], r[1]) for r in flat.df.select(flat.col("id"), flat.col("a.b.c")).collect()] == [(1, 1)]


def test_two_branches_are_refused(spark):
    df = spark.createDataFrame([(1, [(1,)], [(2,)])], "id int, x array<struct<c:int>>, y array<struct<c:int>>")
    with pytest.raises(ValueError, match="one branch"):
        Engine(spark, {"t": df}).run({"from": "t", "select": ["x.c", "y.c"]})


def test_clauses_and_errors(spark):
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(12)], "id int, g int, v double")
    e = Engine(spark, {"t": df})
    with pytest.raises(ValueError, match="unknown clauses"):
        e.run({"from": "t", "selct": "id"})
    with pytest.raises(ValueError, match="needs a sort"):
        e.run({"from": "t", "window": [{"name": "x", "value": "v", "aggregate": "sum", "edges": ["g"], "range": {"min": -1, "max": 0}}]})
    got = e.run({"from": "t", "window": [{"name": "s", "value": "v", "aggregate": "sum", "edges": ["g"], "sort": "id", "range": {"start": -2, "stop": 0}}], "where": {"range": {"s": {"gt": 0}}}, "sort": [{"field": "id", "sort": -1}], "select": ["id", "s"], "limit": 2})
    assert [tuple(r) for r in got.collect()] == [(11, 13.0), (10, 11.0)]


def test_dimensions(spark):
    root = Dimension.parse({"edges": [{"name": "Test", "field": {"suite": "s", "name": "n"}}, {"name": "Os", "field": "os"}]})
    assert expand({"term": {"Os": None}}, root) == {"missing": "os"}
    assert expand({"term": {"Test": {"suite": "a", "name": None}}}, root) == {"and": [{"term": {"s": "a"}}, {"missing": "n"}]}
    assert expand({"exists": "Test"}, root) == {"not": {"and": [{"missing": "s"}, {"missing": "n"}]}}


def model(rows, where):
    ((op, arg),) = where.items()
    if op in ("and", "or"):
        return [r for r in rows if (all if op == "and" else any)(model([r], x) for x in arg)]
    if op == "not":
        return [r for r in rows if not model([r], arg)]
    ((k, v),) = arg.items()
    test = {"term": lambda x: x == v, "terms": lambda x: x in v, "range": lambda x: x is not None and all({"gt": x > b, "lte": x <= b}[o] for o, b in v.items())}[op]
    return [r for r in rows if test(r[k])]


def test_random_filters_agree_with_a_model(spark):
    rng = random.Random(11)
    rows = [{"id": i, "x": rng.choice([None, 1, 2, 3]), "y": rng.choice([None, 10, 20])} for i in range(60)]
    df = spark.createDataFrame([(r["id"], r["x"], r["y"]) for r in rows], "id int, x int, y int").persist()

    def tree(depth):
        kind = rng.choice(["and", "or", "not", "leaf"]) if depth else "leaf"
        if kind == "leaf":
            f = rng.choice("xy")
            return rng.choice([{"term": {f: rng.choice([None, 1, 10])}}, {"terms": {f: rng.choice([[1, None], [2, 20], []])}}, {"range": {f: {"gt": rng.randint(0, 2), "lte": 15}}}])
        return {"not": tree(depth - 1)} if kind == "not" else {kind: [tree(depth - 1) for _ in range(rng.randint(0, 3))]}

    for _ in range(25):
        where = tree(3)
        assert ids(df.filter(filters.compile_filter(where, F.col))) == [r["id"] for r in model(rows, where)], where
