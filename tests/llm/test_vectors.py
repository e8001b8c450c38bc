"""Integer screening, vector codes and centroid clusters against plain integers and SQL."""

import random

import duckdb
import numpy as np
import pytest

from driftwell.llm import centroids, screening, vector_codes
from driftwell.llm import queries as llm

from . import brute

SCHEMA = "vec_id long, embedding array<double>, label long, id string, ints string, code string, cluster string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA)


def exact(x, c):
    found = [brute.closest(r, c.tolist()) for r in x.tolist()]
    return [k for k, _ in found], [d for _, d in found]


@pytest.mark.parametrize("scale", [1, 50, 2**14, 2**24, 2**26])
def test_screening_is_exact(scale):
    """Also where float32 cannot tell the centers apart: they differ by one in one component of a large vector."""
    rng = np.random.default_rng(scale)
    x = rng.integers(-scale, scale + 1, (300, 24))
    near = np.repeat(x[:4], 5, axis=0) + rng.integers(-1, 2, (20, 24))
    c = np.concatenate([near, near[:3], rng.integers(-scale, scale + 1, (5, 24))])
    place, distance = screening.nearest(x, c)
    assert (place.tolist(), distance.tolist()) == exact(x, c)
    low, high = screening.bounds(x, c)
    true = np.array([[sum(v * v for v in b) - 2 * sum(u * v for u, v in zip(a, b, strict=True)) for b in c.tolist()] for a in x[:40].tolist()], dtype=object)
    assert all(lo <= t <= hi for row in zip(low[:40], true, high[:40], strict=True) for lo, t, hi in zip(*row, strict=True))


def test_screening_long_and_empty_vectors():
    rng = np.random.default_rng(7)
    x = rng.integers(-(2**20), 2**20, (5, 2 * screening.BLOCK + 3))
    c = np.concatenate([x[:2] + 1, x[:2] - 1, x[3:4]])
    place, distance = screening.nearest(x, c)
    assert (place.tolist(), distance.tolist()) == exact(x, c)
    place, distance = screening.nearest(np.zeros((3, 0), np.int64), np.zeros((2, 0), np.int64))
    assert place.tolist() == distance.tolist() == [0, 0, 0]


def awkward(length):
    rng = random.Random(length)
    base = [[rng.gauss(0, 1) for _ in range(length)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in base[i % 6]], [None, 1, 1, 2][i % 4]) for i in range(60)]
    rows += [(100, None, 1), (101, [None] * length, 1), (102, [float("nan")] * length, 1), (103, [float("inf")] * length, 2), (104, [0.0] * length, None)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (7, rows[7][1], 1), (None, rows[9][1], 2), (105, [1e9] * length, 3), (106, [-3e38] * length, 3)]
    return rows


def listed(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_vector_codes(spark):
    rows = awkward(64)
    df = frame(spark, rows)
    got = vector_codes.compress(df.repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert listed(got) == sorted(brute.vector_codes([r[:3] for r in rows]), key=str)
    few = rows[:3]
    assert listed(vector_codes.compress(frame(spark, few))) == sorted(brute.vector_codes(few), key=str)
    assert vector_codes.compress(df.limit(0)).count() == 0


def test_vector_codes_of_other_lengths(spark):
    """Each length has codebooks of its own; lengths that are no multiple of the parts are filled up with zeros."""
    rows = [r for n in (16, 64) for r in awkward(n)] + [(200 + i, v + [0.0] * 3, 9) for i, v, _ in awkward(13)[:20]] + [(300, [], 5), (301, [], 5)]
    short = [(i, v[:13], n) if n == 9 else (i, v, n) for i, v, n in rows]
    want = [r for length in (16, 64) for r in brute.vector_codes([r for r in rows if r[1] and len(r[1]) == length and r[2] != 9])] + brute.vector_codes([r for r in rows if r[2] == 9])
    got = listed(vector_codes.compress(frame(spark, short)).drop("label_error"))
    assert [r for r in got if r[0] not in (300, 301)] == sorted(((i, c, e, h) for i, c, e, _, h in want), key=str)
    assert [r[:3] for r in got if r[0] in (300, 301)] == [(300, "00" * 8, 0), (301, "00" * 8, 0)]


def test_codes_stand_for_near_vectors(spark):
    rows = awkward(64)[:60]
    kept = screening.kept(frame(spark, rows), "embedding", 4096, id="vec_id")
    books = vector_codes.fit(kept)
    codes = {r["vec_id"]: r["code"] for r in vector_codes.compress(frame(spark, rows)).collect()}
    for i, v, _ in rows:
        assert np.linalg.norm(vector_codes.decode(codes[i], books[64], 64) - v) < 0.5 * np.linalg.norm(v)


def test_centroids(spark):
    rows = awkward(64) + [(500, [1.0] * 63, 1), (501, [1.0] * 65, 1), (502, [], 1)]
    got = centroids.cluster(frame(spark, rows).repartition(5))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert listed(got) == sorted(brute.centroid_clusters([r[:2] for r in rows]), key=str)
    assert listed(centroids.cluster(frame(spark, rows[:3]))) == sorted(brute.centroid_clusters([r[:2] for r in rows[:3]]), key=str)
    none = centroids.cluster(frame(spark, rows).limit(0))
    assert none.count() == 0 and none.dtypes == got.dtypes


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_centroid_clusters"])
def test_against_sql(spark, name):
    from ..test_oracles import FOLDER, rows

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{FOLDER}/embeddings.parquet'")
    found = con.execute(llm.oracle_sql()[name])
    df = llm.queries()[name](spark, FOLDER)
    got = rows(df.columns, df.collect())
    assert got == rows([c[0] for c in found.description], found.fetchall()) and len(got) == 500
