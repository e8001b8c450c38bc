"""Sinks: scrubbed records, tab and CSV text, blobs, mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scrub(df: DataFrame) -> DataFrame:
    """Lower-case names, empty text as missing, numeric text columns stay text but are trimmed, arrays sorted without gaps."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.nullif(F.trim(c), F.lit(""))
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_sort(F.array_compact(c))
            c = F.when(F.size(c) > 0, c)
        out.append(c.alias(f.name.lower()))
    return df.select(*out)


def numeric_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text columns as doubles where the text is a number, else missing."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def tab_cells(df: DataFrame) -> DataFrame:
    """One text column: JSON-encoded cells with tabs between them."""
    cells = [F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))), r"^\{\"v\":(.*)\}$", 1), F.lit("null")) for c in df.columns]
    cells = [F.when(c == "", F.lit("null")).otherwise(c) for c in cells]
    return df.select(F.concat_ws("\t", *cells).alias("value"))


def write_tabs(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def write_text(df: DataFrame, path: str) -> None:
    df.write.text(path)


def header_and_rows(df: DataFrame) -> DataFrame:
    """A header row and the detail rows as text columns, ready for export; equal rows count once."""
    header = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"`{c}` string" for c in df.columns))
    return header.union(df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])).distinct()


def write_blobs(df: DataFrame, key: str, blob: str, path: str) -> None:
    """A folder for each key with the blob as text."""
    df.select(key, blob).write.partitionBy(key).text(path)


def mail(df: DataFrame, first_id: int = 0) -> tuple[DataFrame, DataFrame]:
    """(content, delivery) of rows (id, to, subject, body): recipients are split at semicolons."""
    content = df.select((F.col("id") + first_id).alias("id"), "subject", F.lit(None).cast("timestamp").alias("date_sent"), "body")
    names = F.filter(F.transform(F.split("to", ";"), lambda x: F.trim(x)), lambda x: x != "")
    return content, df.select((F.col("id") + first_id).alias("content"), F.explode(F.array_distinct(names)).alias("deliver_to"))
