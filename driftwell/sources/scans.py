"""Scans: text, JSON, delimited files, change logs, folders, SQL, and the catalog as metadata."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import jsons

#: Declared store types and their Spark types.
STORE_TYPES = {"string": "string", "boolean": "boolean", "integer": "int", "date": "timestamp", "long": "bigint", "double": "double"}


def records(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Records with the union of their keys as columns; absent keys are missing."""
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], names)


def with_header(spark: SparkSession, header: list[str], rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, header)


def lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def whole(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON with comments and unquoted names allowed; the schema is given, so nothing is scanned to infer it."""
    return spark.read.schema(schema).options(allowComments=True, allowUnquotedFieldNames=True).json(path)


def settings(path: str, params: dict | None = None) -> Any:
    return jsons.loads(Path(path).read_text(encoding="utf8"), params, flexible=True, paths=True)


def tabs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", quote="")


def change_log(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated, URL-escaped change sets: date (seconds), node, revision, author, files, tags, description."""
    raw = tabs(spark, path, "date double, node string, revision string, author string, files string, tags string, description string")
    text = [F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))).alias(c) for c in ("author", "description")]
    return raw.select(F.timestamp_seconds("date").alias("date"), "node", F.col("revision").cast("int"), *text, *[F.filter(F.split(c, " "), lambda x: x != "").alias(c) for c in ("files", "tags")])


def folder(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, length and time of the files; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")


def fields(df: DataFrame, columns: list[str], where: Column | None = None, sort: list[Column] | None = None, limit: int | None = None) -> DataFrame:
    """A plain scan: filter and columns reach the reader; a limit applies only where asked for."""
    out = df.filter(where) if where is not None else df
    out = out.orderBy(*sort) if sort else out
    out = out.select(*columns)
    return out.limit(limit) if limit is not None else out


def sql(spark: SparkSession, text: str, **params: Any) -> DataFrame:
    return spark.sql(text, args=params) if params else spark.sql(text)


def columns_of(df: DataFrame) -> dict[str, list]:
    """The result as columns; for results that are known to be small."""
    table = df.toArrow()
    return {n: table.column(n).to_pylist() for n in table.column_names}


def each(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time."""
    return df.toLocalIterator(prefetchPartitions=True)


def declared(types: dict[str, str]) -> str:
    """A schema from declared store types."""
    unknown = {t for t in types.values() if t not in STORE_TYPES}
    if unknown:
        raise ValueError(f"unknown types {sorted(unknown)}")
    return ", ".join(f"`{n}` {STORE_TYPES[t]}" for n, t in types.items())


def tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())


def table_columns(spark: SparkSession, name: str) -> dict[str, str]:
    return dict(spark.table(name).dtypes)


def jdbc(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A table of a database, read in parallel over ranges of a key."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()
