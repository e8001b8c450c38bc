"""Scans, sinks and the versioned store on small files."""

import pytest
from pyspark.sql import functions as F

from driftwell.sources import scans, sinks
from driftwell.sources.store import Store, new_ids
from driftwell.streaming import incremental


def test_scans(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1, /* note */ "y": "b"}\n{x: 2}\n')
    df = scans.json_lines(spark, str(tmp_path / "a.json"), "x int, y string")
    assert sorted((r["x"], r["y"]) for r in df.collect()) == [(1, "b"), (2, None)]
    assert scans.lines(spark, str(tmp_path / "a.json")).count() == 2 and scans.whole(spark, str(tmp_path / "a.json")).count() == 1
    (tmp_path / "log.tsv").write_text("0.0\tabc\t7\tA%20B\tx.py y.py\ttip\tfix%0Athat%2Bmore\n")
    row = scans.change_log(spark, str(tmp_path / "log.tsv")).first()
    assert (row["node"], row["revision"], row["author"], row["files"], row["description"]) == ("abc", 7, "A B", ["x.py", "y.py"], "fix\nthat+more")
    names = [r["path"].rsplit("/", 1)[1] for r in scans.folder(spark, str(tmp_path), "*.tsv").collect()]
    assert names == ["log.tsv"]
    assert scans.records(spark, [{"a": 1}, {"b": "x", "a": 2}]).columns == ["a", "b"]
    assert scans.declared({"a": "string", "t": "date"}) == "`a` string, `t` timestamp"
    with pytest.raises(ValueError):
        scans.declared({"a": "blob"})
    assert scans.columns_of(scans.sql(spark, "SELECT :v AS v", v=3)) == {"v": [3]}
    assert [r["id"] for r in scans.each(spark.range(3))] == [0, 1, 2]


def test_filters_reach_the_reader(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1).alias("c")).write.parquet(str(tmp_path / "t"))
    plan = scans.fields(spark.read.parquet(str(tmp_path / "t")), ["b"], F.col("a") > 90)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,90)" in plan and "c:int" not in plan.split("ReadSchema")[1]


def test_filters_of_the_language_reach_the_reader(spark, tmp_path):
    from driftwell.plans.query import Engine

    spark.createDataFrame([(1, "ab"), (None, None), (5, "b")], "a int, b string").write.parquet(str(tmp_path / "t"))
    engine = Engine(spark, {"t": spark.read.parquet(str(tmp_path / "t"))})
    where = [{"range": {"a": {"gte": 1, "lt": 9}}}, {"terms": {"a": [1, 2]}}, {"prefix": {"b": "a"}}]
    for f, pushed in zip(where, (("GreaterThanOrEqual(a,1)", "LessThan(a,9)"), ("In(a, [1,2])",), ("StringStartsWith(b,a)",)), strict=True):
        plan = engine.run({"from": "t", "select": ["a"], "where": {"and": [f, {"exists": "a"}]}})._jdf.queryExecution().executedPlan().toString()
        assert all(x in plan for x in pushed), plan
    count = lambda f: engine.run({"from": "t", "select": ["a"], "where": f}).count()
    assert count({"and": where}) == 1 and count({"not": where[0]}) == 1 and count({"not": {"or": where}}) == 1 and count({"or": where}) == 2


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    with pytest.raises(KeyError):
        store.read("t")
    one = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    store.insert("t", one)
    store.insert_new("t", spark.createDataFrame([(None, "m"), (2, "b"), (2, "c")], "k int, v string"), ["k"])
    assert store.read("t").count() == 3 and store.read("t", 0).count() == 2
    store.update("t", F.col("v") == "a", {"v": F.upper("v"), "k": 9})
    assert sorted(str(r["k"]) for r in store.delete("t", F.col("v") == "n").collect()) == ["2", "9"]
    store.prune("t")
    assert len(store.versions("t")) == 1
    assert new_ids(one, 10).select("id").distinct().count() == 2


def test_writes_after_prune_and_rollback_stay_newest(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for i in range(3):
        store.write("t", spark.range(i, i + 1))
    store.prune("t")
    assert [r["id"] for r in store.write("t", spark.range(100, 101)).collect()] == [100]
    store.insert("t", spark.range(200, 201))
    assert sorted(r["id"] for r in store.read("t").collect()) == [100, 200]
    store.rollback("t")
    assert [r["id"] for r in store.insert("t", spark.range(300, 301)).orderBy("id").collect()] == [100, 300]
    store.prune("t")
    assert [r["id"] for r in store.read("t").orderBy("id").collect()] == [100, 300]


def test_update_by_query(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write("t", spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"))
    store.update_query("t", {"from": "t", "set": {"v": "x"}, "where": {"not": {"term": {"v": "a"}}}})
    assert sorted(tuple(r) for r in store.read("t").collect()) == [(1, "a"), (2, "x"), (3, "x")]
    store.update_query("t", {"set": {"k": {"script": "k * 10"}}, "where": {"range": {"k": {"gte": 2}}}})
    assert sorted(tuple(r) for r in store.update_query("t", {"set": {"v": None}}).collect()) == [(1, None), (20, None), (30, None)]
    with pytest.raises(ValueError):
        store.update_query("t", {"set": {"v": 1}, "limit": 3})


def test_insert_appends_a_folder_and_takes_a_batch_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.insert("t", spark.createDataFrame([(1, "a")], "k int, v string"), batch=("files", 0))
    first = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("s/t/0*/*.parquet")}
    store.insert("t", spark.createDataFrame([(2, 0.5)], "k int, w double"), batch=("files", 1))
    store.insert("t", spark.createDataFrame([(2, 0.5)], "k int, w double"), batch=("files", 1))
    assert sorted((r["k"], r["v"], r["w"]) for r in store.read("t").collect()) == [(1, "a", None), (2, None, 0.5)]
    now = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("s/t/0*/*.parquet")}
    assert first.items() <= now.items() and len(store.versions("t")) == 2
    store.insert("t", spark.createDataFrame([(2**40,)], "k long"))
    assert store.read("t").agg(F.max("k")).first()[0] == 2**40


def test_changes_write_only_the_folders_they_touch(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    row = lambda a, b: spark.range(a, b).select("id", F.concat(F.lit("v"), "id").alias("v"))
    store.write("t", row(0, 100), keys=["id"])
    for a in (100, 200, 300):
        store.insert("t", row(a, a + 100))
    first = store.folders("t")
    rewritten = lambda: len(set(first) - set(store.folders("t")))
    assert len(first) == 4 and rewritten() == 0
    store.update_slice("t", {"id": 150}, {"v": "x"})
    assert rewritten() == 1 and len(store.folders("t")) == 4
    store.delete("t", F.col("v") == "v50")
    assert rewritten() == 2
    store.merge("t", spark.createDataFrame([(310, "m"), (1000, "n")], "id long, v string"), ["id"])
    assert rewritten() == 3 and first[2] in store.folders("t")
    store.update_join("t", spark.createDataFrame([(1000, "p"), (1000, "o")], "id long, v string"), ["id"], ["v"])
    store.delete_in("t", spark.createDataFrame([(10**6,), (None,)], "id long"), ["id"])
    assert rewritten() == 3
    got = {r["id"]: r["v"] for r in store.read("t").collect()}
    want = {i: f"v{i}" for i in range(400) if i != 50} | {150: "x", 310: "m", 1000: "p"}
    assert got == want
    store.prune("t")
    assert {r["id"]: r["v"] for r in store.compact("t").collect()} == want and len(store.folders("t")) == 1
    assert store.delete("t", F.lit(True)).count() == 0 and store.insert("t", row(5, 6)).count() == 1


def test_looks_into_folders_by_ranges_of_keys(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    one = lambda *k: spark.createDataFrame([(x, 1) for x in k], "k string, n int")
    store.write("t", one("a", "c"), keys=["k"])
    store.insert("t", one("m", None))
    store.insert("t", spark.createDataFrame([], "k string, n int"))
    look = lambda *k: [store.folders("t").index(f) for f in store._maybe(store._last("t"), one(*k), ["k"])]
    assert look("b") == [0] and look("m", "z") == [1] and look(None) == [1] and look("b", "n") == [0, 1] and look("d") == [] and look() == []
    assert store.insert_new("t", one("a", "b", None), ["k"]).count() == 5


def test_columns_and_wider_types_are_schema_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.write("t", spark.createDataFrame([(1, 0.5, "p")], "k short, f float, p string"), partition=["p"])
    first = store.folders("t")
    store.add_column("t", "extra", "string")
    store.insert("t", spark.createDataFrame([(2**40, 1e300)], "k long, f double"))
    store.insert("t", spark.createDataFrame([(3, "q")], "k byte, p string"))
    assert store.folders("t")[:1] == first and store.read("t").columns == ["k", "f", "p", "extra"]
    assert sorted(map(tuple, store.read("t").collect())) == [(1, 0.5, "p", None), (3, None, "q", None), (2**40, 1e300, None, None)]
    store.update("t", F.col("p") == "p", {"extra": "e", "p": "r"})
    assert store.read("t").filter("extra = 'e' and p = 'r'").count() == 1 and len(store.folders("t")) == 3
    store.insert("t", spark.createDataFrame([("text",)], "k string"))
    assert sorted(r["k"] for r in store.read("t").collect()) == ["1", "1099511627776", "3", "text"]
    with pytest.raises(ValueError):
        store.insert("t", spark.createDataFrame([([1],)], "k array<int>"))
    with pytest.raises(ValueError):
        store.add_column("t", "k", "int")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb", None), (2, '"q"', [3])], "k int, v string, l array<int>")
    assert [r["value"] for r in sinks.tab_cells(df).orderBy("value").collect()] == ['1\t"a\\tb"\tnull', '2\t"\\"q\\""\t[3]']
    sinks.write_blobs(df, "k", "v", str(tmp_path / "b"))
    assert (tmp_path / "b" / "k=1").is_dir()
    assert sinks.numeric_text(spark.createDataFrame([("1.5",), ("x",)], "v string"), ["v"]).filter("v = 1.5").count() == 1
    sinks.write_csv(df.select("k", "v"), str(tmp_path / "c"))
    sinks.write_tabs(df.select("k", "v"), str(tmp_path / "d"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2


def test_new_files_are_read_once(spark, tmp_path):
    seen = []
    for i in range(2):
        spark.range(i * 3, i * 3 + 3).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.run_available(spark, str(tmp_path / "in"), "id long", str(tmp_path / "progress"), lambda df, n: seen.extend(r["id"] for r in df.collect()))
    assert sorted(seen) == list(range(6))
