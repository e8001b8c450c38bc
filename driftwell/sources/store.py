"""A store of tables as versioned folders: a version is a pointer that lists Parquet folders, and it is moved into place last.

A reader sees the old version or the new one, never a part. An insert writes the new rows only: its version lists the folders
of the one before and one more. Nothing is changed in place: update, delete and merge write those folders anew that hold a
row they change, and the new version lists the other folders as they are. The pointer also holds

- the schema, so that a new column, or a wider number, needs no rewriting and reading opens no footers beforehand;
- for each folder the least and the greatest value of the table's ``keys``, so that changes by key do not look into folders
  that cannot hold one of them. Ranges are kept for whole numbers, text, dates and timestamps; a folder without them is looked into.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import null_safe
from ..operators.stored import written
from ..plans import filters

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: The folder in a file's path.
FOLDER = r".*/(\d{6,}-[0-9a-f]{8})/"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def wider(old: T.DataType, new: T.DataType) -> bool:
    """Whether the Parquet reader gives files of the old type as the new one."""
    if isinstance(old, WHOLE) and isinstance(new, WHOLE):
        return WHOLE.index(type(old)) < WHOLE.index(type(new))
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def merged(old: T.StructType, new: T.StructType) -> T.StructType | None:
    """The schema that both can be read in as they are; None: a column needs rewriting."""
    fields = {f.name: f.dataType for f in old}
    for f in new:
        have = fields.get(f.name, f.dataType)
        if have != f.dataType and not wider(have, f.dataType) and not wider(f.dataType, have):
            return None
        fields[f.name] = f.dataType if wider(have, f.dataType) else have
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def together(now: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of both in the common types: text where one side is text, else the type that Spark's union finds."""
    a, b = ({f.name: f.dataType for f in df.schema} for df in (now, rows))
    text = [c for c in a if c in b and a[c] != b[c] and isinstance(a[c], T.StringType) != isinstance(b[c], T.StringType)]
    if bad := [c for c in text if isinstance(a[c], T.StringType) and not isinstance(b[c], T.AtomicType) or isinstance(b[c], T.StringType) and not isinstance(a[c], T.AtomicType)]:
        raise ValueError(f"no common type of the columns {bad}")
    a, b = (df.withColumns({c: F.col(quoted(c)).cast("string") for c in text}) for df in (now, rows))
    return a.unionByName(b, allowMissingColumns=True)


def code(kind: T.DataType, name: str) -> Column | None:
    """A key as a number or text whose order is that of the key."""
    c = F.col(quoted(name))
    if isinstance(kind, WHOLE):
        return c.cast("long")
    if kind == T.StringType():
        return c
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    return F.unix_micros(c) if isinstance(kind, T.TimestampType) else None


def ranges(df: DataFrame, keys: Iterable[str]) -> dict[str, list]:
    """For each key that has an order here: its least and greatest value, and whether it is missing somewhere."""
    kinds = {f.name: f.dataType for f in df.schema}
    codes = {k: c for k in keys if k in kinds and (c := code(kinds[k], k)) is not None}
    if not codes:
        return {}
    row = df.agg(*[f(c) for c in codes.values() for f in (F.min, F.max, lambda x: F.coalesce(F.max(x.isNull()), F.lit(False)))]).first()
    return {k: list(row[3 * i : 3 * i + 3]) for i, k in enumerate(codes)}


def can_hold(held: dict[str, list], wanted: dict[str, list]) -> bool:
    """Whether a folder with the ranges ``held`` may have a row within all of ``wanted``."""
    for k, (low, high, missing) in wanted.items():
        if k not in held:
            continue
        a, b, none = held[k]
        if not (missing and none or a is not None and low is not None and low <= b and a <= high):
            return False
    return True


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # Versions -----------------------------------------------------------------------------------------------------
    def versions(self, name: str) -> list[str]:
        """Written versions, oldest first; a version counts once its pointer exists."""
        at = self._path(f"{self.root}/{name}/_current")
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def _pointer(self, name: str, version: str) -> dict:
        """folders: what the version consists of; batches: the last batch of each stream that it holds."""
        stream = self._fs.open(self._path(f"{self.root}/{name}/_current/{version}"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def last_batch(self, name: str, stream: str) -> int:
        """The last batch of a stream that the table holds; -1: none."""
        return self._last(name)["batches"].get(stream, -1)

    def last_written(self, name: str) -> str | None:
        """When the newest version was published (UTC, ISO)."""
        return self._last(name).get("at")

    def _last(self, name: str) -> dict:
        v = self.versions(name)
        return {"folders": [], "batches": {}, "keys": [], "partition": [], "ranges": {}} | (self._pointer(name, v[-1]) if v else {})

    def _frame(self, name: str, pointer: dict, folders: list[str]) -> DataFrame:
        """The rows of some of a version's folders, in the version's schema."""
        paths = [f"{self.root}/{name}/{f}" for f in folders]
        schema = T.StructType.fromJson(pointer["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        # Spark reads partition folders below one root only.
        roots = [[p] for p in paths] if pointer["partition"] else [paths]
        return reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(*r) for r in roots])

    def read(self, name: str, version: int = -1) -> DataFrame:
        v = self.versions(name)
        if not v:
            raise KeyError(name)
        pointer = self._pointer(name, v[version])
        rows = self._frame(name, pointer, pointer["folders"])
        # The reader puts partition columns last.
        return rows.select(*[quoted(f["name"]) for f in pointer["schema"]["fields"]]) if pointer["partition"] else rows

    def folders(self, name: str) -> list[str]:
        """The folders that the newest version consists of."""
        return self._last(name)["folders"]

    def _next(self, name: str) -> str:
        # Numbers go on from the newest version, so that they stay in order whatever was pruned or rolled back.
        v = self.versions(name)
        return f"{int(v[-1].split('-')[0]) + 1 if v else 0:06d}-{uuid.uuid4().hex[:8]}"

    def _put(self, name: str, df: DataFrame, draft: dict) -> str:
        """The rows as a new folder of the draft of a version, in its types; columns that they lack are not written."""
        folder, have = self._next(name), set(df.columns)
        fields = {f.name: f.dataType for f in T.StructType.fromJson(draft["schema"])}
        rows = df.select(*[F.col(quoted(c)).cast(t).alias(c) if c in have else F.lit(None).cast(t).alias(c) for c, t in fields.items() if c in have or c in draft["partition"]])
        path = f"{self.root}/{name}/{folder}"
        (rows.write.partitionBy(*draft["partition"]) if draft["partition"] else rows.write).parquet(path)
        draft["folders"] = [*draft["folders"], folder]
        draft["ranges"] = draft["ranges"] | {folder: ranges(self._frame(name, draft, [folder]), draft["keys"])}
        return folder

    def _publish(self, name: str, draft: dict) -> DataFrame:
        version = self._next(name)
        held = {f: draft["ranges"].get(f, {}) for f in draft["folders"]}
        at = self._path(f"{self.root}/{name}/_draft-{version}")
        out = self._fs.create(at)
        out.write(bytearray(json.dumps(draft | {"ranges": held, "at": dt.datetime.now(dt.UTC).isoformat()}).encode()))
        out.close()
        self._fs.mkdirs(self._path(f"{self.root}/{name}/_current"))
        if not self._fs.rename(at, self._path(f"{self.root}/{name}/_current/{version}")):
            raise OSError(f"cannot publish {version} of {name}")
        return self.read(name)

    def write(self, name: str, df: DataFrame, partition: list[str] | None = None, batches: dict[str, int] | None = None, keys: list[str] | None = None) -> DataFrame:
        """A new version of the rows of ``df`` alone. The one that is read for it stays until ``prune``.

        Partition columns and keys (whose ranges are kept) stay those of the version before where none are given.
        """
        last, have = self._last(name), set(df.columns)
        draft = {
            "folders": [], "ranges": {}, "schema": df.schema.jsonValue(), "batches": last["batches"] if batches is None else batches,
            "partition": [c for c in (last["partition"] if partition is None else partition) if c in have],
            "keys": last["keys"] if keys is None else list(keys),
        }
        self._put(name, df, draft)
        return self._publish(name, draft)

    def _forget(self, name: str, gone: list[str]) -> None:
        """Delete versions, and the folders that no other version lists."""
        used = {f for v in self.versions(name) if v not in gone for f in self._pointer(name, v)["folders"]}
        folders = {f for v in gone for f in self._pointer(name, v)["folders"]} - used
        for v in gone:
            self._fs.delete(self._path(f"{self.root}/{name}/_current/{v}"), False)
        for f in folders:
            self._fs.delete(self._path(f"{self.root}/{name}/{f}"), True)

    def prune(self, name: str, keep: int = 1) -> None:
        """Delete all but the newest versions."""
        self._forget(name, self.versions(name)[:-keep])

    def rollback(self, name: str) -> None:
        """The version before becomes current."""
        self._forget(name, self.versions(name)[-1:])

    def alias(self, view: str, name: str) -> None:
        """A temporary view on the current version."""
        self.read(name).createOrReplaceTempView(view)

    # Changes ------------------------------------------------------------------------------------------------------
    def insert(self, name: str, rows: DataFrame, batch: tuple[str, int] | None = None) -> DataFrame:
        """Append; columns are the union of both. A batch (stream, number) that the table holds already is not added again.

        Only the new rows are written, unless a column's type differs: then both are written anew in the common type.
        """
        last = self._last(name)
        if batch and batch[1] <= last["batches"].get(batch[0], -1):
            return self.read(name)
        batches = last["batches"] | ({batch[0]: batch[1]} if batch else {})
        if not self.exists(name):
            return self.write(name, rows, batches=batches)
        schema = merged(T.StructType.fromJson(last["schema"]), rows.schema)
        if schema is None:
            return self.write(name, together(self.read(name), rows), batches=batches)
        draft = last | {"schema": schema.jsonValue(), "batches": batches}
        self._put(name, rows, draft)
        return self._publish(name, draft)

    def insert_new(self, name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """Append the rows whose key is not there yet; missing key values equal each other. Only folders that may hold one are read."""
        rows = rows.dropDuplicates(keys)
        if not self.exists(name):
            return self.write(name, rows, keys=keys)
        last = self._last(name)
        held = self._frame(name, last, self._maybe(last, rows, keys))
        return self.insert(name, rows.alias("n").join(held.alias("o"), null_safe("n", "o", keys), "left_anti"))

    def add_column(self, name: str, column: str, kind: str) -> DataFrame:
        """A column that is missing in every row; no row is written."""
        last = self._last(name)
        schema = T.StructType.fromJson(last["schema"])
        if column in schema.names:
            raise ValueError(f"{name} has a column {column}")
        return self._publish(name, last | {"schema": schema.add(column, T.DataType.fromDDL(kind)).jsonValue()})

    def compact(self, name: str) -> DataFrame:
        """The same rows in one folder, after many small changes."""
        return self.write(name, self.read(name))

    def _maybe(self, pointer: dict, rows: DataFrame, keys: list[str]) -> list[str]:
        """The folders whose ranges overlap those of the rows' keys. Keys of another type than the table's say nothing."""
        kinds, theirs = ({f.name: f.dataType for f in s} for s in (T.StructType.fromJson(pointer["schema"]), rows.schema))
        alike = [k for k in keys if k in pointer["keys"] and (kinds[k] == theirs[k] or isinstance(kinds[k], WHOLE) and isinstance(theirs[k], WHOLE))]
        wanted = ranges(rows, alike)
        return [f for f in pointer["folders"] if can_hold(pointer["ranges"].get(f, {}), wanted)]

    def _touched(self, rows: DataFrame) -> set[str]:
        """The folders that rows with a column ``file_`` come from."""
        return {r[0] for r in rows.select(F.regexp_extract("file_", FOLDER, 1)).distinct().collect()}

    def _change(self, name: str, touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame], maybe: list[str] | None = None) -> DataFrame:
        """Writes anew the folders in which ``touched`` finds rows; all of them where the change alters a column's type."""
        last = self._last(name)
        if not last["folders"]:
            raise KeyError(name)
        everything = change(self._frame(name, last, last["folders"]))
        kinds = {f["name"]: f["type"] for f in last["schema"]["fields"]}
        if {f["name"]: f["type"] for f in everything.schema.jsonValue()["fields"]} != kinds:
            return self.write(name, everything.select(*[quoted(c) for c in kinds]))
        maybe = last["folders"] if maybe is None else maybe
        gone = self._touched(touched(self._frame(name, last, maybe))) if maybe else set()
        draft = last | {"folders": [f for f in last["folders"] if f not in gone]}
        if gone:
            self._put(name, change(self._frame(name, last, sorted(gone))), draft)
        return self._publish(name, draft)

    def _change_where(self, name: str, where: Column, change: Callable[[DataFrame], DataFrame], maybe: list[str] | None = None) -> DataFrame:
        return self._change(name, lambda df: df.filter(where).select(F.input_file_name().alias("file_")), change, maybe)

    def _change_matching(self, name: str, other: DataFrame, keys: list[str], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """As ``_change`` for rows whose key is in ``other``, which should be written: it is read several times."""
        found = lambda df: df.select(*[quoted(k) for k in keys], F.input_file_name().alias("file_")).alias("o").join(other.alias("n"), null_safe("o", "n", keys), "left_semi")
        return self._change(name, found, change, self._maybe(self._last(name), other, keys))

    def update(self, name: str, where: Column, values: dict[str, Column | object]) -> DataFrame:
        """Values are computed from the row as it was; ``where`` must not depend on chance."""
        return self._change_where(name, where, self._setting(where, values))

    def _setting(self, where: Column, values: dict[str, Column | object]) -> Callable[[DataFrame], DataFrame]:
        hit = F.coalesce(where, F.lit(False))

        def change(df: DataFrame) -> DataFrame:
            if unknown := set(values) - set(df.columns):
                raise ValueError(f"unknown columns {sorted(unknown)}")
            new = {k: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(quoted(k))).alias(k) for k, v in values.items()}
            return df.select(*[new.get(c, F.col(quoted(c))) for c in df.columns])

        return change

    def update_query(self, name: str, q: dict) -> DataFrame:
        """An update of the query language: {"set": {column: value, or {"script": text}}, "where": filter}; no filter takes every row."""
        if unknown := set(q) - {"from", "set", "where"}:
            raise ValueError(f"unknown clauses {sorted(unknown)}")
        values = {k: filters.script(v["script"]) if isinstance(v, dict) and set(v) == {"script"} else v for k, v in q["set"].items()}
        return self.update(name, filters.compile_filter(q.get("where", True)), values)

    def update_slice(self, name: str, slice_: dict, values: dict) -> DataFrame:
        """Where the slice's values are equal; missing ones match missing ones."""
        test = F.lit(True)
        for k, v in slice_.items():
            test = test & F.col(k).eqNullSafe(F.lit(v))
        one = self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in slice_.items()])
        return self._change_where(name, test, self._setting(test, values), self._maybe(self._last(name), one, list(slice_)))

    def update_join(self, name: str, other: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
        """Rows whose key is in ``other`` take its columns; of several rows of a key the largest tuple of columns counts."""
        best = written(other.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("new_")))

        def change(df: DataFrame) -> DataFrame:
            both = df.alias("o").join(best.alias("n"), null_safe("o", "n", keys), "left")
            new = {c: F.when(F.col("n.new_").isNotNull(), F.col(f"n.new_.{quoted(c)}")).otherwise(F.col(f"o.{quoted(c)}")).alias(c) for c in columns}
            return both.select(*[new.get(c, F.col(f"o.{quoted(c)}")) for c in df.columns])

        return self._change_matching(name, best, keys, change)

    def delete(self, name: str, where: Column) -> DataFrame:
        return self._change_where(name, where, lambda df: df.filter(~F.coalesce(where, F.lit(False))))

    def delete_in(self, name: str, other: DataFrame, keys: list[str]) -> DataFrame:
        """Without the rows whose key is in ``other``."""
        gone = written(other.select(*keys).distinct())
        return self._change_matching(name, gone, keys, lambda df: df.alias("o").join(gone.alias("n"), null_safe("o", "n", keys), "left_anti"))

    def merge(self, name: str, changes: DataFrame, keys: list[str]) -> DataFrame:
        """Rows of ``changes`` replace those with their key; the others are added. Columns are the union of both."""
        if not self.exists(name):
            return self.write(name, changes, keys=keys)
        last = self._last(name)
        schema = merged(T.StructType.fromJson(last["schema"]), changes.schema)
        if schema is None:
            old = self.read(name).alias("o").join(changes.alias("n"), null_safe("o", "n", keys), "left_anti")
            return self.write(name, together(old, changes))
        # The changes are written first, as a folder of the new version, and read from there.
        draft = last | {"schema": schema.jsonValue(), "keys": last["keys"] or list(keys)}
        fresh = self._put(name, changes, draft)
        new = self._frame(name, draft, [fresh]).select(*keys)
        maybe = [f for f in self._maybe(draft, new, keys) if f != fresh]
        held = self._frame(name, draft, maybe).select(*keys, F.input_file_name().alias("file_")).alias("o")
        gone = self._touched(held.join(new.alias("n"), null_safe("o", "n", keys), "left_semi")) if maybe else set()
        draft["folders"] = [f for f in last["folders"] if f not in gone]
        if gone:
            self._put(name, self._frame(name, draft, sorted(gone)).alias("o").join(new.alias("n"), null_safe("o", "n", keys), "left_anti"), draft)
        draft["folders"] = [*draft["folders"], fresh]
        return self._publish(name, draft)


def new_ids(df: DataFrame, start: int = 0, name: str = "id") -> DataFrame:
    """Distinct increasing ids, in blocks per partition."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start))
