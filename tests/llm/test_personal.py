"""Personal data: base spans against their patterns, added spans against examples that the model did not see."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftwell.llm import personal, pii_forms
from driftwell.llm import queries as llm

from . import brute

SCHEMA = "doc_id long, text string, spans string, kind string, key string, score double"
CARD = "4465758382889437"
TEXTS = [
    None, "", " ", "a@b.c d.e@f", "x a.b+c%d@mail-1.example.com, a@b..c a@b a@@b.c é@x.y ü.a@b.c_d@e.f", "1.2.3.4.5.6.7.8.9 256.1.1.1 001.002.003.255 1.2.3 1..2.3.4 9999.1.1.1",
    f"{CARD} {CARD}-x {CARD[:4]} {CARD[4:8]}-{CARD[8:12]} {CARD[12:]}, {CARD}  {CARD}", "+1 (659) 555-3949 +12 +1 2 +49 30 1234567.. ++4930123456789 +123456789012345678 +1(2)3-4 .", "日本語 +1 (659) 555-3949 é a@b.de",
    f"call (659) 555-3949 or 0049 30 1234567, card {CARD} {CARD} now", "write to jane.doe (at) mail (dot) example (dot) com please, or joe at mail dot example dot org today", "ssn: 123-45-6789 and iban DE89 3704 0044 0532 0130 00 at 2001:db8:85a3::8a2e:370:7334 ok",
    "order no. 1234567890, 2024-05-17 12:30:45, isbn 978-3-16-148410-0, 000-12-3456, std::string, let us meet at home.Then go",
]


@pytest.fixture(scope="module")
def contexts():
    rng = random.Random(5)
    words = [pii_forms._name(rng) for _ in range(300)]
    return [" ".join(rng.choice(words) + rng.choice(("", "", ",", ".")) for _ in range(25)) for _ in range(400)]


@pytest.fixture(scope="module")
def frame(spark, contexts):
    rows = [(i, t, "a", "b", "c", 1.0) for i, t in enumerate(TEXTS)] + [(None, TEXTS[7], "a", "b", "c", 1.0), (3, TEXTS[3], None, None, None, None)]
    return spark.createDataFrame(rows + [(1000 + i, t, "a", "b", "c", 0.0) for i, t in enumerate(contexts)], SCHEMA).repartition(4)


@settings(max_examples=400, deadline=None)
@given(st.text("a@.+-% (019)_é", max_size=40) | st.text("0123456789.- ", max_size=60) | st.text("+0123456789 ()-.", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    want = brute.personal(text)
    assert [f"{pii_forms.KINDS[k]}:{s}:{e}" for s, e, k in pii_forms.base(text)] == want[-1]


@pytest.mark.parametrize("text", ["a" * 300_000, "a@" * 150_000, "a@b" * 100_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000, "+1" * 150_000, "+" + "1-" * 150_000, ":" * 300_000, "a:" * 150_000, " at " * 75_000, "DE12 " * 60_000, "(at)" * 75_000])
def test_long_texts_take_linear_time(text):
    began = time.perf_counter()
    pii_forms.base(text)
    found = pii_forms.proposals(text)
    assert time.perf_counter() - began < 6 and len(found) < 6 * len(text)


def test_report(spark, frame):
    got = personal.report(frame).collect()
    assert len(got) == frame.count()
    by = {r["doc_id"]: r for r in got}
    for i, t in [*enumerate(TEXTS), (None, TEXTS[7])]:
        r, want = by[i], brute.personal(t)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == want[:-1], i
        assert set(want[-1]) <= set(r["spans"].split(",")), i
    added = lambda i: {(s.split(":")[0], TEXTS[i][int(s.split(":")[1]) : int(s.split(":")[2])]) for s in by[i]["spans"].split(",") if s.split(":")[0] in pii_forms.ADDED}
    assert added(9) == {("local_phone", "(659) 555-3949"), ("local_phone", "0049 30 1234567"), ("card_part", CARD)}
    assert added(10) == {("written_email", "jane.doe (at) mail (dot) example (dot) com"), ("written_email", "joe at mail dot example dot org")}
    assert added(11) == {("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("ipv6", "2001:db8:85a3::8a2e:370:7334")}
    assert by[12]["spans"] == ""
    assert all(r["spans"] == "" for r in got if (r["doc_id"] or 0) >= 1000)
    assert sum(r["doc_id"] == 3 for r in got) == 2
    again = {(r["doc_id"], r["spans"]) for r in personal.report(frame.repartition(7)).collect()}
    assert again == {(r["doc_id"], r["spans"]) for r in got}
    assert personal.report(frame.limit(0)).count() == 0
    bare = personal.report(frame.filter("doc_id is null or text is null")).collect()
    assert {r["doc_id"]: r["n_phone"] for r in bare}[None] == brute.personal(TEXTS[7])[3]


def test_redact(spark, frame):
    model = personal.model_from(frame)
    clean = personal.redact(frame, model)
    assert clean.schema == frame.schema
    got = {r["doc_id"]: r for r in clean.collect()}
    assert got[0]["text"] is None and got[1]["text"] == "" and got[3]["spans"] in ("a", None)
    assert got[8]["text"] == "日本語 [phone] é [email]"
    assert got[9]["text"] == "call [local_phone] or [local_phone], card [card_part] [card_part] now"
    assert got[11]["text"] == "ssn: [ssn] and iban [iban] at [ipv6] ok" and got[12]["text"] == TEXTS[12]
    assert personal.redact(frame.limit(0), None).count() == 0


def test_held_out_examples(contexts):
    """Right spans among those taken, and those taken among the right ones, per kind, on examples of another seed."""
    models = personal.model_of(contexts)
    _, kinds, x, y = personal.taught(contexts, 99, 6000)
    for k, kind in enumerate(pii_forms.ADDED):
        mine, model = kinds == k, models[k]
        took = personal.calibrated(model, x[mine]) >= model["threshold"]
        assert y[mine][took].mean() > 0.97 and took[y[mine] == 1].mean() > 0.95, kind


def test_contexts_are_those_of_the_smallest_hashes(spark, frame, monkeypatch):
    """However many rows the first bound lets through: of 20 texts among 400 empty ones it lets through too few."""
    sparse = frame.filter("doc_id < 1020").unionByName(frame.filter("doc_id >= 1020").selectExpr("doc_id", "'' AS text", "spans", "kind", "key", "score"))
    for rows in (frame, sparse):
        whole = personal.contexts(rows, "doc_id", "text")
        for n in (1, 10, 15):
            monkeypatch.setattr(personal, "SAMPLE", n)
            assert personal.contexts(rows.repartition(3), "doc_id", "text") == whole[: n * personal.WINDOWS]
        monkeypatch.undo()


def test_overlaps():
    rng = random.Random(2)
    for _ in range(200):
        spans = sorted((s, s + rng.randint(1, 60), 0) for s in (rng.randrange(200) for _ in range(rng.randint(0, 6))))
        held = pii_forms.apart(spans)
        for _ in range(20):
            s = rng.randrange(220)
            e = s + rng.randint(1, 40)
            assert pii_forms.covered((s, e, 0), *held) == any(a < e and b > s for a, b, _ in spans)
        ranked = [((s, e, k), 1.0) for s, e, k in rng.sample(spans, len(spans))]
        want = []
        for (s, e, k), q in ranked:
            if all(a >= e or b <= s for a, b, _, _ in want):
                want.append((s, e, k, q))
        assert personal.apart(ranked) == want


def test_query_on_whole_table(spark):
    import duckdb

    texts = dict(duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    got = llm.queries()["op13_personal_data"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.personal(texts[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) == want[:-1]
        assert set(want[-1]) <= set(r["spans"].split(","))
