"""Sharding: contiguous shards of near-equal bytes from global prefix sums.

Rows are put in one global order, by the 64-bit hash of their text, so equal texts stand side by side. Hash ranges
("bins") are totalled first, the totals are turned into starts by a prefix sum, and only then is each bin summed up
inside; no task ever sees more than its own bin. Cuts lie at equal byte targets.

Equal texts form one unit and stay in one shard, unless they weigh more than a thousandth of a shard: then the group is
split into parts of about that weight, so a text that fills a third of the table cannot unbalance anything.

Shards and slots do not depend on how the rows lie in files, except that rows equal in id and text may change places.

Edge cases: a null text has size 1 (no bytes, plus 1) and checksum 0; a null id is an ordinary value; repeated rows are
separate rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Stash, text_or_empty

BINS = 4096
#: A shard holds at least so many units of equal texts; heavier groups are split.
GRAIN = 1000
SLOT_BINS = 1024
#: About so many equal rows are numbered in one task.
CHUNK = 4096


def numbered(rows: DataFrame, stash: Stash) -> DataFrame:
    """``rows`` with ``dh``, the hash of id, text and, among rows equal in both, of a number from 0 on.

    Which of the equal rows gets which number depends on the files, but they are interchangeable, and the hashes are the same
    under every split. Many equal rows are numbered in chunks, after a prefix sum of the chunks' sizes.
    """
    again = stash.keep(rows.groupBy("key", "th").agg(F.count("*").alias("n")).filter("n > 1"), "again").alias("a")
    same = F.col("r.key").eqNullSafe(F.col("a.key")) & (F.col("r.th") == F.col("a.th"))
    alone = rows.alias("r").join(again, same, "left_anti").withColumn("dh", F.xxhash64("key", "th"))
    chunk = F.pmod(F.xxhash64("r.rid"), F.ceil(F.col("a.n") / CHUNK))
    equal = stash.keep(rows.alias("r").join(again, same).select("r.*", chunk.alias("chunk")), "equal")
    sizes = equal.groupBy("key", "th", "chunk").agg(F.count("*").alias("n"))
    before = W.partitionBy("key", "th").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)
    bases = stash.keep(sizes.select("key", "th", "chunk", (F.sum("n").over(before) - F.col("n")).alias("base")), "bases").alias("b")
    mine = F.row_number().over(W.partitionBy("key", "th", "chunk").orderBy("rid"))
    placed = equal.withColumn("own", mine).alias("r").join(bases, F.col("r.key").eqNullSafe(F.col("b.key")) & (F.col("r.th") == F.col("b.th")) & (F.col("r.chunk") == F.col("b.chunk")))
    return alone.unionByName(placed.select("r.key", "size", "crc", "r.th", "rid", F.xxhash64("r.key", "r.th", F.col("base") + F.col("own")).alias("dh")))


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` counts from 0 without gaps in each shard. ``law`` is ``bytes``: the shards' sizes are near equal.
    """
    stash = Stash(docs.sparkSession, "sharding")
    t = text_or_empty(text)
    rows = stash.keep(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(t) + F.lit(1)).cast("long").alias("size"),
            F.crc32(t).alias("crc"),
            F.xxhash64(t).alias("th"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "rows",
    )
    rows = numbered(rows, stash)
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total"))
    most = F.col("total") / F.lit(shards * GRAIN)
    # Groups over the grain number at most shards * GRAIN, since their sizes sum to no more than the total.
    heavy = (
        rows.groupBy("th")
        .agg(F.sum("size").alias("bytes"))
        .crossJoin(F.broadcast(total))
        .filter(F.col("bytes") > most)
        .select("th", F.ceil(F.col("bytes") / most).alias("parts"))
    )
    placed = rows.join(F.broadcast(heavy), "th", "left").withColumn(
        "part", F.coalesce(F.pmod("dh", "parts"), F.lit(0)).cast("long")
    )
    units = (
        placed.groupBy("th", "part")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("bin", F.shiftrightunsigned("th", 52))
    )
    starts = (
        units.groupBy("bin")
        .agg(F.sum("bytes").alias("bin_bytes"))
        .withColumn(
            "bin_start",
            F.sum("bin_bytes").over(W.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)) - F.col("bin_bytes"),
        )
        .select("bin", "bin_start")
    )
    inside = W.partitionBy("bin").orderBy("th", "part").rowsBetween(W.unboundedPreceding, 0)
    middle = F.col("bin_start") + F.sum("bytes").over(inside) - F.col("bytes") / 2
    cut = (
        units.join(F.broadcast(starts), "bin")
        .crossJoin(F.broadcast(total))
        .select("th", "part", F.least(F.floor(middle * shards / F.col("total")), F.lit(shards - 1)).cast("int").alias("shard"))
    )
    sharded = stash.keep(
        placed.join(cut, ["th", "part"]).select("key", "size", "crc", "th", "rid", "shard", F.pmod("dh", F.lit(SLOT_BINS)).alias("slot_bin")),
        "sharded",
    )
    counted = sharded.groupBy("shard", "slot_bin").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("slot_bin").rowsBetween(W.unboundedPreceding, 0)
    bases = counted.select("shard", "slot_bin", (F.sum("n").over(before) - F.col("n")).alias("base"))  # shards * SLOT_BINS rows at most
    rank = F.row_number().over(W.partitionBy("shard", "slot_bin").orderBy("key", "th", "rid"))
    return (
        sharded.join(F.broadcast(bases), ["shard", "slot_bin"])
        .select(
            F.col("key").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("base") + rank - 1).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
