"""Queries over whole tables: each against its registered SQL, on larger tables than those of test_oracles."""

import math
import re

import duckdb
import pytest

from driftwell import queries
from driftwell.operators import stored
from driftwell.queries import relational

from .test_oracles import TABLES, near, rows

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def holds(spark, duck, name, cut, around="{}"):
    """The rows of a query, after they were found equal to those of its SQL without ``cut``, put into ``around``."""
    df = queries.queries()[name](spark, FOLDER)
    found = duck.execute(around.format(queries.oracle_sql()[name].replace(cut, "")))
    names = [c[0] for c in found.description]
    got, want = rows(df.columns, df.collect()), rows(names, found.fetchall())
    assert sorted(names) == sorted(df.columns) and len(got) == len(want)
    assert all(near(x, y) for a, b in zip(got, want, strict=True) for x, y in zip(a, b, strict=True))
    return got


@pytest.mark.parametrize("name", ["alerts_reconciled", "alerts_rolled_up", "alerts_to_send", "alerts_hierarchy"])
def test_every_order_is_an_alert(spark, duck, name):
    got = holds(spark, duck, name, " WHERE o_orderkey % 10 = 0")
    if name == "alerts_reconciled":
        assert len(got) == duck.execute("SELECT count(*) FROM orders").fetchone()[0] + 1


def test_duplicates_are_searched_in_the_whole_table(spark, duck):
    got = holds(spark, duck, "report_duplicates", " WHERE o_orderkey BETWEEN 100 AND 9000")
    assert any(9000 < x for row in got for x in row if isinstance(x, int))


def test_union_and_product_fold_all_orders(spark, duck):
    got = holds(spark, duck, "fold_union_product", " WHERE o_orderkey < 4000")
    assert all(math.isfinite(x) for row in got for x in row if isinstance(x, float))


def test_image_of_all_customers_of_a_segment(spark, duck):
    holds(spark, duck, "join_image", " AND c_custkey < 60")


def test_every_document_is_cleaned(spark, duck):
    cut = " WHERE contains(text, 'the') OR contains(text, 'que')"
    got = holds(spark, duck, "strings_clean", cut, "SELECT * REPLACE (CASE WHEN first = 999999 THEN -1 ELSE first END AS first) FROM ({})")
    assert len(got) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert any(-1 in row for row in got)


def test_pivot_can_be_written(spark, duck, tmp_path):
    """Columns p and P are told apart by the session of the rows, also where they are written; that of the caller stays as it was."""
    df = queries.queries()["pivot_discovered"](spark, FOLDER)
    df.write.parquet(path := str(tmp_path / "pivot"))
    back = df.sparkSession.read.parquet(path)
    found = duck.execute(queries.oracle_sql()["pivot_discovered"])
    assert back.columns == [c[0] for c in found.description] and sorted(map(tuple, back.collect())) == sorted(found.fetchall())
    assert [r[0] for r in df.select("P").orderBy("p").collect()] == [r[0] for r in back.orderBy("p").select("P").collect()]
    assert spark.conf.get("spark.sql.caseSensitive") == "false" and df.sparkSession.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_wide_facts_in_tasks_of_bounded_size(spark, duck, monkeypatch):
    """Lines and orders meet in tasks whose number follows from the rows, whatever the number of shuffle partitions."""
    holds(spark, duck, "report_wide_facts", "")
    monkeypatch.setattr(relational, "tasks", lambda df: stored.tasks(df, 2000))
    lines, key = duck.execute("SELECT count(*) FROM lineitem").fetchone()[0], "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        text = queries.queries()["report_wide_facts"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        dealt = [int(n) for n in re.findall(r"hashpartitioning\([lo]_orderkey#\d+L?, (\d+)\)", text)]
        assert len(dealt) == 3 and set(dealt) == {-(-lines // 2000)}
        holds(spark, duck, "report_wide_facts", "")
    finally:
        spark.conf.set(key, before)
