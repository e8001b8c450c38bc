"""Intervals, variants, SQL names, indexes, stages, cubes, defaults, timing and pushed filters, beyond their queries."""

import random

import pytest
from pyspark.sql import functions as F

from driftwell import queries
from driftwell.functions import sqlnames, variants
from driftwell.operators import intervals, joins
from driftwell.operators.cube import Cube
from driftwell.operators.timing import Steps
from driftwell.plans.defaults import with_defaults, with_defaults_of
from driftwell.plans.query import Engine
from driftwell.sources.keyed import Index
from driftwell.sources.store import Store
from driftwell.streaming.progress import Stages

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dyadic_nodes_are_the_interval(spark):
    rng = random.Random(1)
    pairs = [(a, rng.randint(a - 1, 63)) for a in (rng.randint(0, 63) for _ in range(60))] + [(0, 63), (5, 5), (63, 63), (7, 3)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", intervals.nodes(F.col("a"), F.col("b"), 6).alias("n"))
    for r in df.collect():
        cells = sorted(c for n in r["n"] for c in range(n["node"] << n["level"], (n["node"] + 1) << n["level"]))
        assert cells == list(range(r["a"], r["b"] + 1)) and len(r["n"]) <= 12


@pytest.mark.parametrize("levels", [1, 4, 12])
@pytest.mark.parametrize("open_end", [False, True])
def test_interval_join(spark, levels, open_end):
    rng = random.Random(levels)
    points = [(rng.choice([None, *range(50)]), i) for i in range(60)]
    records = [(rng.choice([None, *range(-10, 60)]), rng.choice([None, *range(-10, 60)]), i) for i in range(60)]
    p, r = spark.createDataFrame(points, "at int, p int"), spark.createDataFrame(records, "lo int, hi int, r int")
    got = intervals.interval_join(p, r, "lo", "hi", "at", open_end, levels)
    want = [(*x, *y) for x in points for y in records if x[0] is not None and y[0] is not None and y[0] <= x[0] and (y[1] is None or (x[0] < y[1] if open_end else x[0] <= y[1]))]
    assert listed(got) == sorted(want, key=str)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    assert intervals.interval_join(p.limit(0), r, "lo", "hi", "at").count() == 0 == intervals.interval_join(p, r.limit(0), "lo", "hi", "at").count()


def test_snapshot_keeps_empty_partitions(spark):
    parts = spark.createDataFrame([(1,), (5,), (9,), (9,)], "at int")
    records = spark.createDataFrame([("a", 0, 5), ("b", 5, None), ("c", 7, 6)], "name string, lo int, hi int")
    got = joins.snapshot(records.filter("name <> 'b'"), parts, "lo", "hi", "at")
    assert listed(got) == sorted([(1, "a", 0, 5), (5, "a", 0, 5), (9, None, None, None), (9, None, None, None)], key=str)
    assert "NestedLoop" not in plan(joins.snapshot(records, parts, "lo", "hi", "at"))


@pytest.mark.parametrize("kind", ["int", "double", "timestamp"])
def test_held_counts_what_the_join_gives(spark, kind):
    rng = random.Random(5)
    points = [(rng.choice([None, *range(50)]),) for _ in range(60)]
    records = [(rng.choice([None, *range(-10, 60)]), rng.choice([None, *range(-10, 60)])) for _ in range(200)]
    of = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} int" for n in names)).select(*[F.col(n).cast(kind) for n in names])
    p, r = of(points, ["at"]), of(records, ["lo", "hi"])
    want = {x: sum(x is not None and lo is not None and lo <= x and (hi is None or x <= hi) for lo, hi in records) for (x,) in points}
    got = lambda *a: listed(intervals.held(*a, "lo", "hi", "at").select(F.col("at").cast("long"), "n"))
    assert got(p, r) == sorted(want.items(), key=str) and 0 in want.values() and None in want
    assert got(p, r.limit(0)) == sorted(((x, 0) for x in want), key=str) and got(p.limit(0), r) == []


def test_snapshot_counts_write_no_pairs(spark, tmp_path):
    """Ten copies of the items give ten times the counts, without a join of items with days."""
    def run(times):
        for t in ("orders", "lineitem"):
            key = f"{t[0]}_orderkey"
            rows = spark.read.parquet(f"{FOLDER}/{t}.parquet").crossJoin(spark.range(times))
            rows.withColumn(key, F.col(key) + F.col("id") * 10**6).drop("id").write.parquet(f"{tmp_path}/{times}/{t}.parquet")
        df = queries.queries()["snapshot_irregular"](spark, f"{tmp_path}/{times}")
        assert "node_" not in plan(df)
        return {r["d"]: r["n"] for r in df.collect()}

    one, ten = run(1), run(10)
    assert ten == {d: 10 * n for d, n in one.items()} and sum(one.values()) > 0


def test_sweep(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "x", "y"]), rng.randint(-5, 25), rng.randint(-5, 25), rng.randint(1, 9)) for _ in range(200)]
    got = intervals.sweep(spark.createDataFrame(rows, "k string, a int, b int, v int"), ["k"], F.col("a"), F.col("b"), 20, {"v": F.col("v")})
    want = {}
    for k, a, b, v in rows:
        for part in range(max(a, 0), min(b, 19) + 1):
            n, s = want.get((k, part), (0, 0))
            want[k, part] = (n + 1, s + v)
    assert listed(got) == sorted(((k, p, n, s) for (k, p), (n, s) in want.items()), key=str)


def test_variants(spark):
    rows = spark.createDataFrame([(1, '{"a": {"b": [1, {"c": "x"}]}, "t": true}'), (2, "[]"), (3, "{bad"), (4, None), (5, '{"a": 1}')], "id int, j string").withColumn("v", variants.parsed(F.col("j")))
    got = {r["id"]: tuple(r)[1:] for r in rows.select("id", variants.at(F.col("v"), "a.b[1].c"), variants.at(F.col("v"), "a.b[0]", "int"), variants.at(F.col("v"), "t", "boolean")).collect()}
    assert got == {1: ("x", 1, True), 2: (None,) * 3, 3: (None,) * 3, 4: (None,) * 3, 5: (None,) * 3}
    each = variants.items(rows.select("id", F.try_variant_get("v", "$.a.b", "variant").alias("b")), "b", outer=True)
    assert listed(each.select("id", F.col("item.pos"))) == sorted([(1, 0), (1, 1), (2, None), (3, None), (4, None), (5, None)], key=str)
    assert "Python" not in plan(each)


def test_sql_names(spark):
    assert len(sqlnames.register(spark)) == len(sqlnames.SCALAR) + len(sqlnames.TABLE)
    got = spark.sql("""SELECT string_between('a<b>c', '<', '>') a, string_between('ab', '<', '>') b, string_left('abc', -1) c, string_right('abc', 5) d, string_remove_control('a\tb') e, string_word_count(NULL, ',') f,
      json_number('{"a": {"b": 1.5}}', 'a.b') g, time_milli(TIMESTAMP '1970-01-01 00:00:01') h, time_floor_week(TIMESTAMP '2024-01-17 10:00:00') i, string_locate('z', 'abc') j""").first()
    assert tuple(got)[:8] == ("b", None, "", "abc", "a b", None, 1.5, 1000) and str(got["i"]) == "2024-01-14 00:00:00" and got["j"] == 4
    assert [r["value"] for r in spark.sql("SELECT * FROM digits_below(3)").collect()] == [0, 1, 2] and spark.sql("SELECT * FROM digits_below(0)").count() == 0
    assert spark.sql("SELECT * FROM time_parts(TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-02', 1)").count() == 0
    assert [r["word"] for r in spark.sql("SELECT word FROM string_words('a.b', '.')").collect()] == ["a", "b"]


def test_index_prunes_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(i % 50, i % 7, i) for i in range(500)] + [(None, 1, -1)], "k int, n int, v int")
    index = Index.build(rows, "index_of_test", ["k", "n"], str(tmp_path / "index"), 8)
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    try:
        assert "SelectedBucketsCount: 1 out of 8" in plan(index.get(7))
        assert int(plan(index.get([7, 9, 11])).split("SelectedBucketsCount: ")[1].split()[0]) <= 3
    finally:
        spark.conf.unset(auto)
    assert listed(index.get(7, 0)) == [r for r in listed(rows) if r[:2] == (7, 0)] and listed(index.get(None)) == [(None, 1, -1)]
    with pytest.raises(ValueError):
        index.get(1, 2, 3)
    joined = index.matching(spark.createDataFrame([(7, "a"), (9, "b")], "k int, name string").repartition(3))
    assert joined.count() == 20


def test_stages_take_each_batch_once(spark, tmp_path):
    store, seen = Store(spark, str(tmp_path)), []

    def step(name, fail):
        def run(rows):
            seen.append(name)
            if seen.count(name) == fail:
                raise RuntimeError(name)
            return rows.groupBy("k").agg(F.sum("v").alias("v"))

        return run

    stages = Stages(store, [("one", step("one", 2)), ("two", step("two", 1))])
    batches = [spark.createDataFrame([("a", i), ("a", 1), ("b", i)], "k string, v long") for i in range(3)]
    runs = 0
    while True:
        runs += 1
        try:
            for n, rows in enumerate(batches):
                stages.take(rows, n)
            break
        except RuntimeError:
            continue
    assert runs == 3 and seen == ["one", "two", "two", "one", "one", "two", "one", "two"]
    assert listed(stages.rows("two")) == sorted([("a", 1), ("a", 2), ("a", 3), ("b", 0), ("b", 1), ("b", 2)])
    last = stages.last_runs()
    assert {k: v[0] for k, v in last.items()} == {"one": 2, "two": 2} and all(v[1].startswith("20") for v in last.values())
    with pytest.raises(ValueError):
        stages.take(batches[0], 4)


def test_cube_arithmetic(spark):
    cube = lambda rows, edges: Cube(spark.createDataFrame(rows, ", ".join([f"{e} string" for e in edges] + ["m double"])), dict.fromkeys(edges), ["m"])
    a, b = cube([("x", "1", 6.0), (None, "1", 4.0), ("z", "2", 1.0)], ["e", "f"]), cube([("x", 2.0), (None, 8.0), ("y", 5.0)], ["e"])
    assert listed((a / b).df) == sorted([("x", "1", 3.0), (None, "1", 0.5)], key=str)
    assert sorted((b * a).df.select("e", "f", "m").collect(), key=str) == sorted((a * b).df.select("e", "f", "m").collect(), key=str)
    assert listed(a.combine(b, lambda x, y: x + y, default=0).df) == sorted([("x", "1", 8.0), (None, "1", 12.0), ("z", "2", 1.0)], key=str)
    assert listed(b.combine(cube([("w", 1.0)], ["e"]), lambda x, y: x - y, default=0).df) == sorted([("x", 2.0), (None, 8.0), ("y", 5.0), ("w", -1.0)], key=str)
    one = Cube(spark.createDataFrame([(2.0,)], "m double"), {}, ["m"])
    assert listed((b - one).df) == sorted([("x", 0.0), (None, 6.0), ("y", 3.0)], key=str) == listed((b - 2).df) and listed((10 - b).df)[0][1] in (8.0, 2.0, 5.0)
    assert listed((b / 0).df) == sorted([("x", None), (None, None), ("y", None)], key=str)
    with pytest.raises(ValueError):
        _ = b + cube([("1", 1.0)], ["f"])


def test_defaults(spark):
    schema = "id int, a struct<b:int,c:struct<d:string,e:array<int>>>, z string"
    rows = spark.createDataFrame([(1, (None, ("x", None)), None), (2, None, "kept"), (3, (4, None), None)], schema)
    full = with_defaults(rows, {"a": {"b": 7, "c": {"d": "def", "e": [1]}}, "z": "none", "new": 5})
    assert listed(full.select("id", "a.b", "a.c.d", "a.c.e", "z", "new")) == [(1, 7, "x", [1], "none", 5), (2, 7, "def", [1], "kept", 5), (3, 4, "def", [1], "none", 5)]
    other = spark.createDataFrame([(1, (9, ("o", [2])), "oz", "more")], schema + ", w string")
    got = with_defaults_of(rows, other, ["id"])
    assert listed(got.select("id", "a.b", "a.c.d", "a.c.e", "z", "w")) == [(1, 9, "x", [2], "oz", "more"), (2, None, None, None, "kept", None), (3, 4, None, None, None, None)]


def test_steps(spark):
    steps = Steps()
    for n in (3, 4):
        assert steps.run("count", spark.range(n), lambda d: d.collect(), total=F.sum("id"))
    r = steps.table(spark).first()
    assert (r["step"], r["calls"], r["rows"]) == ("count", 2, 7) and r["seconds"] > 0 and steps.taken["count"][3] == {"total": 6}


def test_filters_reach_the_reader(spark):
    e = Engine(spark, {"t": spark.read.parquet(f"{FOLDER}/events.parquet")})
    run = lambda w: e.run({"from": "t", "select": ["event_id"], "where": w})
    pushed = lambda w: plan(run(w)).split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThan" in pushed({"not": {"range": {"value": {"gt": 20, "lte": 60}}}}) and "LessThanOrEqual" in pushed({"not": {"range": {"value": {"gt": 20, "lte": 60}}}})
    assert "In(event_type" in pushed({"not": {"terms": {"event_type": ["click", "view"]}}}) and "GreaterThan(user_id,5)" in pushed({"script": "user_id > 5"})
    assert "IsNull" in pushed({"not": {"exists": "value"}})


def test_negations_agree(spark):
    """Pushed inwards or not, a negation gives the rows that its filter does not give."""
    rows = spark.createDataFrame([(i, x, s) for i, (x, s) in enumerate((x, s) for x in (None, 1.0, 2.0, float("nan"), 3.0) for s in (None, "a", "ab", "b"))], "id int, x double, s string")
    e = Engine(spark, {"t": rows})
    ids = lambda w: {r["id"] for r in e.run({"from": "t", "select": ["id"], "where": w}).collect()}
    one = [{"term": {"x": 1.0}}, {"term": {"s": None}}, {"terms": {"s": ["a", None]}}, {"terms": {"x": [1.0, 3.0]}}, {"range": {"x": {"gte": 2}}}, {"range": {"x": {">": 1, "<": 3}}}, {"range": {"x": {"from": 1, "to": 2}}}, {"prefix": {"s": "a"}}, {"missing": "x"}, {"exists": "s"}, {"script": "x > 1"}, {"term": {"x": 1.0, "s": "a"}}]
    every = set(range(20))
    for f in one + [{"and": one[:5:2]}, {"or": one[1::3]}, {"not": one[4]}, {"or": [{"and": one[3:5]}, {"not": {"or": one[7:9]}}]}]:
        assert ids({"not": f}) == every - ids(f), f


def test_scripts_over_nested_rows(spark):
    rows = spark.createDataFrame([(1, [(1, "a.b"), (20, None)], 3), (2, [], 4), (3, None, 5)], "id int, items array<struct<q:int,n:string>>, k int")
    run = lambda s: listed(Engine(spark, {"t": rows}).run({"from": "t", "select": ["id", "items.q"], "where": {"script": s}}))
    assert run("items.q > 10") == [(1, 20)] and run("items.n = 'a.b' and k = 3") == [(1, 1)] and run("coalesce(items.q, 0) = 0") == [(2, None), (3, None)]


@pytest.mark.parametrize("name", ["times_relative", "times_of_day", "join_band", "snapshot_irregular", "report_daily_range"])
def test_events_are_never_broadcast(spark, name):
    text = plan(queries.queries()[name](spark, FOLDER))
    assert "LeftOuter" not in text or "BroadcastNestedLoopJoin BuildRight, LeftOuter" not in text
    if name == "join_band":
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
