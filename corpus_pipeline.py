"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns a table with the columns of ``documents``; the last returns the
packed pieces.

1. toxicity: documents that score 0.5 or more go. The model learns from the labels of the stage's own documents.
2. near_duplicates: five-word shingles, Jaccard similarity of 0.8 or more; of each group the smallest id stays.
3. secrets: each secret becomes ``[kind]``, ``n_chars`` follows.
4. mixing: documents are taken, repeated or left out as their source's target says.
5. packing: token ids in sequences of at most 1024.

Edge cases are those of the operators; rows with a null id pass the first four stages as documents of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.llm import jaccard, mixing, packing, secrets, toxicity
from driftwell.llm.common import Stash, released
from driftwell.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: SQL cannot express the toxicity model or the tokenizer; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs.select(*COLUMNS), toxicity.model_from(docs, labels))
    return scored.filter("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    classes = jaccard.jaccard_components(docs, size=5, percent=80)
    kept = classes.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").withColumn("h_", F.xxhash64("text")).dropDuplicates(["doc_id", "h_"])
    return named.select(*COLUMNS).unionByName(docs.filter("doc_id is null").select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``. A stage's intermediate tables go once its result is written."""
    stash, docs = Stash(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        with released(spark):
            docs = stash.keep(stage(spark, docs, sf_dir), name)
        if i:
            stash.drop(STAGES[i - 1][0])
    return STAGES[-1][1](spark, docs, sf_dir)
