"""The pipeline's stages one by one on a small table, each against what it promises."""

import random

import pytest

import corpus_pipeline

from . import brute
from .test_operators import WORDS, rows_of


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(300):
        w = [rng.choice(WORDS) + str(rng.randint(0, 9)) for _ in range(60)]
        if i % 3 == 0:
            w[5] = "idiot"
        rows.append([i, " ".join(w), "en", f"s{i % 4}", 0])
        labels.append((i, 1, int(i % 3 == 0)))
    rows[2][1] = rows[1][1]
    rows[4][1] = rows[1][1].replace(rows[1][1].split()[7], "other")
    rows[7][1] += " token = abcdef123"
    rows += [[1000, None, None, None, None], [1001, "", "en", None, 0]]
    out = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return str(out), {r[0]: r[1] for r in rows}


def test_stages(spark, folder):
    path, texts = folder
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    clean = corpus_pipeline.drop_toxic(spark, docs, path).persist()
    ids = {r["doc_id"] for r in clean.collect()}
    assert clean.columns == columns and len([i for i in ids if i < 300 and i % 3 == 0]) <= 2 and len(ids) >= 198
    unique = corpus_pipeline.drop_near_duplicates(spark, clean, path).persist()
    want = brute.jaccard([(i, texts[i]) for i in ids], 5, 80)
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(i for i in ids if want[i][1] == i)
    assert 2 not in {r["doc_id"] for r in unique.collect()}
    safe = corpus_pipeline.redact_secrets(spark, unique, path)
    got = rows_of(safe, "doc_id")
    assert got[7]["text"].endswith("[assign]") and got[7]["n_chars"] == len(got[7]["text"]) and got[1000]["text"] is None
    mixed = corpus_pipeline.mix_sources(spark, safe, path)
    assert mixed.columns == columns and 0 < mixed.count() <= 3 * unique.count()


def test_run_and_empty(spark, folder, tmp_path):
    path, _ = folder
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, path)
    assert docs.count() == 0
