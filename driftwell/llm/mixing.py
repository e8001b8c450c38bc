"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a hash. A document's virtual finish time in pass r is
(r * source size + words of the source up to and including it) / weight. Passes are put in global order of finish time
and the order is truncated where the total budget is used up. Sources that the budget would exhaust repeat, three passes
at most.

Sums run in two steps, totals of hash buckets first and rows of one bucket second, so a source with a third of all rows
is spread over as many tasks as the others together. The global order is cut into ranges of finish time; the one range in
which the budget ends is cut again, twice, and only what is left is sorted row by row: a source has at most weight x width
documents there, as its finish times lie at least 1 / weight apart.

Edge cases: a null text has size 0 and is never taken; a null source is a source of its own and comes last; a null id
is an ordinary value; long texts are counted whole; a table with no words gives targets of 0; repeated rows are separate
documents; rows equal in id and size are ordered by a hash of the text; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, Stash

#: How often a document may be taken.
PASSES = 3
RANGES = 4096
CYCLE = 3


def shuffle_key(key: str, size: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("#"), F.col(size).cast("string")))


def targets(sizes: DataFrame, passes: int = PASSES) -> DataFrame:
    """source, source_size, weight, target from (source, source_size): weights 1, 2, 3, repeating by code point, null last.

    Water filling in closed form: with sources in the order in which they reach their cap, the level is the largest of
    (budget - caps before) / (weights from here on).
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", ((F.row_number().over(order) - 1) % CYCLE + 1).cast("long"))
    cap = F.lit(passes) * F.col("source_size")
    filled = W.orderBy(cap / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    rest, all_ = filled.rowsBetween(0, W.unboundedFollowing), W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(all_) - (F.sum(cap).over(filled.rowsBetween(W.unboundedPreceding, 0)) - cap)) / F.sum("weight").over(rest)
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(all_))
        .withColumn("target", F.least(F.col("weight") * F.col("level"), cap.cast("double")))
    )


def narrowed(items: DataFrame, at: DataFrame, stash: Stash, name: str) -> tuple[DataFrame, DataFrame]:
    """The items of the one range of finish times in which the budget ends, and that range as the next to be divided.

    ``at`` (one row): where the ranges start, how wide they are, the words before them, the budget.
    """
    number = F.greatest(F.lit(0), F.least(F.floor((F.col("finish") - F.col("low")) / F.col("step")), F.lit(RANGES)))
    ranged = items.crossJoin(F.broadcast(at)).withColumn("range", number)
    totals = ranged.groupBy("range", "low", "step", "before", "budget").agg(F.sum("size").alias("words"))
    running = W.orderBy("range").rowsBetween(W.unboundedPreceding, 0)
    last = (
        totals.withColumn("after", F.col("before") + F.sum("words").over(running))
        .filter("after >= budget")
        .agg(F.min(F.struct("range", "low", "step", (F.col("after") - F.col("words")).alias("before"), "budget")).alias("last"))
        .select("last.*")
    )
    last = stash.keep(last, f"{name}_range")
    kept = stash.keep(ranged.select("size", "mix_key", "finish", "range").join(F.broadcast(last.select("range")), "range").drop("range"), name)
    return kept, last.select((F.col("low") + F.col("range") * F.col("step")).alias("low"), (F.col("step") / RANGES).alias("step"), "before", "budget")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", passes: int = PASSES) -> DataFrame:
    """key, size, source_size, target, taken, passes (whole passes of the document that the mix takes), source."""
    stash = Stash(docs.sparkSession, "mixing")
    rows = stash.keep(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(text).alias("text_hash"),
        ).withColumn("mix_key", shuffle_key("key", "size")),
        "rows",
    ).withColumn("bucket", F.substring("mix_key", 1, 3))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goal = stash.keep(targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), passes), "goal")
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    starts = buckets.select("source", "bucket", (F.sum("words").over(upto) - F.col("words")).alias("start")).alias("b")
    placed = starts.join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        "b.source", "bucket", "start", "source_size", "weight", "level", "target"
    )
    within = W.partitionBy("source", "bucket").orderBy("mix_key", "text_hash").rowsBetween(W.unboundedPreceding, 0)
    summed = rows.withColumn("inside", F.sum("size").over(within)).alias("r")
    both = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bucket") == F.col("b.bucket"))
    queued = stash.keep(
        summed.join(placed.alias("b"), both).select(
            "r.key", "r.source", "r.size", "r.text_hash", "r.mix_key", "source_size", "weight", "level", "target", (F.col("inside") + F.col("start")).alias("upto")
        ),
        "queued",
    )
    finish = lambda r: ((F.col("source_size") * r + F.col("upto")) / F.col("weight")).cast("double")
    items = queued.select("size", "mix_key", F.explode(F.array(*[finish(r) for r in range(passes)])).alias("finish")).filter("size > 0")
    at = goal.agg(
        F.lit(0.0).alias("low"), (F.max("level") * 2 / RANGES).alias("step"), F.lit(0).cast("long").alias("before"), F.sum("source_size").alias("budget")
    )
    for name in ("first", "second", "third"):
        items, at = narrowed(items, at, stash, name)
    in_order = W.orderBy("finish", "mix_key").rowsBetween(W.unboundedPreceding, 0)
    cut = (
        items.crossJoin(F.broadcast(at))
        .withColumn("sum", F.col("before") + F.sum("size").over(in_order))
        .select(
            # The whole range may exceed the budget at its first document: then the order ends just before the range.
            F.when(F.col("sum") <= F.col("budget"), F.struct("finish", "mix_key")).alias("item"),
            F.struct(F.col("finish").alias("finish"), F.lit("").alias("mix_key")).alias("first"),
        )
        .agg(F.coalesce(F.max("item"), F.min("first")).alias("cut"))
    )
    whole = lambda r: F.when((F.col("size") > 0) & (F.struct(finish(r).alias("finish"), "mix_key") <= F.col("cut")), 1).otherwise(0)
    return (
        queued.crossJoin(F.broadcast(cut))
        .withColumn("passes", sum((whole(r) for r in range(passes)), F.lit(0)))
        .select(
            F.col("key").alias(key), "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"),
            F.col("passes").cast("int"), F.col("source").alias(source), "text_hash",
        )
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as rows: each document as often as it is taken, columns as in ``docs``."""
    same = [F.col(key).alias("k"), F.col(source).alias("s"), F.col("text_hash").alias("h")]
    taken = mix(docs, key, text, source).groupBy(*same).agg(F.sum("passes").cast("int").alias("n")).filter("n > 0")
    # Rows equal in id, source and text are alike; one of them stands for all their passes.
    one = docs.withColumn("h_", F.xxhash64(text)).dropDuplicates([key, source, "h_"]).alias("d")
    pair = F.col(f"d.{key}").eqNullSafe(F.col("t.k")) & F.col(f"d.{source}").eqNullSafe(F.col("t.s")) & (F.col("d.h_") == F.col("t.h"))
    rows = one.join(taken.alias("t"), pair)
    return rows.select(*[F.col(f"d.{c}") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("t.n"))).alias("pass_")).drop("pass_")
