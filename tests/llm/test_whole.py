"""Whole private keys, and vectors of every length."""

import duckdb
from pyspark.sql import functions as F

from ..test_oracles import rows


def pem(width, lines, end, kind="RSA ", headers="", close=True):
    """(text of a key, what has to be taken out)"""
    body = [("MIIEow+/9aB" * 8)[i % 5 :][:width] for i in range(lines)] + ["q83vASNFZ4mrze8BI0Vng=="]
    shut = [f"-----END {kind}PRIVATE KEY-----"] if close else []
    return end.join([f"-----BEGIN {kind}PRIVATE KEY-----" + headers.replace("\n", end), *body, *shut])


KEYS = {
    "lines": pem(64, 25, "\n"), "crlf": pem(64, 25, "\r\n"), "openssh": pem(70, 8, "\n", "OPENSSH "), "old": pem(76, 8, "\n", ""), "escaped": pem(64, 8, "\\n"), "one line": pem(64, 8, " "),
    "headers": pem(64, 8, "\n", headers="\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF\n"), "no end": pem(64, 25, "\n", close=False), "no end, crlf": pem(64, 3, "\r\n", close=False),
    "no end, long": pem(64, 20_000, "\n", close=False), "long": pem(64, 20_000, "\n"), "header only": "-----BEGIN PRIVATE KEY-----",
}


def test_whole_private_keys_are_taken_out(spark):
    from driftwell.llm import oracles, secrets
    from driftwell.llm.trigrams import derive

    assert derive(secrets.PRIVATE_KEY) == derive("-----BEGIN [A-Z ]*PRIVATE KEY-----")
    texts = {k: f"before: {v}\nafter, prose." for k, v in KEYS.items()} | {"two": f"{KEYS['no end']}\n\n{KEYS['lines']} and {KEYS['openssh']}!"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean == {k: "before: [private_key]\nafter, prose." for k in KEYS} | {"two": "[private_key]\n\n[private_key] and [private_key]!"}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(texts.items()))
    report = secrets.report(docs)
    found = con.execute(oracles.secret_scans())
    assert rows(report.columns, report.collect()) == rows([c[0] for c in found.description], found.fetchall())


def test_vectors_of_every_length_take_part(spark):
    """Two lengths in turn: links and neighbours are found within each, never across."""
    from driftwell.llm import nearest, vector_dedup

    unit = lambda dim, i: [1.0 if j == i else 0.01 * (i + 1) for j in range(dim)]
    data = [(i, unit(6, i)) for i in range(6)] + [(10 + i, unit(6, i % 2)) for i in range(2)] + [(20 + i, unit(4, i)) for i in range(4)] + [(30, unit(4, 3)), (40, [2.0]), (41, [3.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_duplicates(df).collect()}
    pairs = {0: 10, 10: 0, 1: 11, 11: 1, 23: 30, 30: 23, 40: 41, 41: 40}
    assert got == {i: (int(i in pairs), min(i, pairs.get(i, i)), i <= pairs.get(i, i)) for i, _ in data}
    near = {}
    for r in nearest.nearest(df, F.col("vec_id") >= 0, k=20, share=1e9).collect():
        near.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    size = {i: len(v) for i, v in data}
    assert {i: set(v.values()) for i, v in near.items()} == {i: {j for j in size if size[j] == size[i] and j != i} for i in size}
    assert all(near[i][1] == j for i, j in pairs.items())
