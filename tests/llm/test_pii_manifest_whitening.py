"""PII, Merkle manifest and whitening against plain versions, and odd tables."""

import math
import os
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from brute import SF_MID, SF_SMALL
from tickline.llm import manifest, pii, whitening
from tickline.llm.queries import QUERIES

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


# ---- PII ---------------------------------------------------------------------------------------

ALPHABET = st.text(alphabet="0123456789+-. ()@aZ_%,é\n", max_size=60)


@settings(max_examples=400, deadline=None)
@given(ALPHABET)
def test_base_spans_match_the_patterns(text):
    assert pii.base_spans(text) == brute.personal(text)


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (212) 555-0100 x", "+1 234", "x@y", "@a.b", "..@a.b.c.", "00000001.2.3.4", "1.2.3.4" * 3, "4111 1111 1111 1111" * 2, "a.b+c@x-y.z-"],
)
def test_base_spans_of_odd_texts(text):
    assert pii.base_spans(text) == brute.personal(text)


@pytest.mark.parametrize("text", ["9" * 300_000, "a" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 2 " * 75_000, "((((" * 75_000, "1:" * 100_000, "@ " * 150_000, " at " * 75_000, "1" + "." * 300_000])
def test_long_texts_take_linear_time(text):
    import time

    start = time.perf_counter()
    pii.spans_of([text], None)
    pii.proposals(text)
    assert time.perf_counter() - start < 20


@pytest.fixture(scope="module")
def model(spark):
    return pii.train(pii.labelled(spark.read.parquet(os.path.join(SF_MID, "documents.parquet"))))


def test_the_model_adds_spans(spark, model):
    documents = spark.read.parquet(os.path.join(SF_MID, "documents.parquet")).where("doc_id % 2 = 1")
    # fresh items, of documents and draws that training has not seen
    rows = pii.labelled(documents.withColumn("text", F.concat(F.lit("x "), "text")), train_docs=300)
    kinds, feats, label = zip(*[(r["kind"], r["f"], r["label"]) for r in rows.collect()], strict=True)
    label = np.array(label)
    p = model.probability(list(kinds), np.array(feats))
    chosen = p >= np.array([model.least[k] for k in kinds])
    assert label[chosen].mean() > 0.93 and chosen[label == 1].mean() > 0.7
    texts = ["Please call: (212) 555-0187 today", "write to jane.doe [at] mail.com now", "token = \"4e95835415d967660e41234567\"", "version 12.2.2021, ISBN 978-3-12-148410-0"]
    found = [[(s["kind"], t[s["start"] : s["end"]]) for s in f] for t, f in zip(texts, pii.spans_of(texts, model), strict=True)]
    assert found == [[("phone", "(212) 555-0187")], [("email", "jane.doe [at] mail.com")], [], []]


def test_op11(spark):
    documents = duckdb.sql(f"SELECT doc_id, text FROM '{os.path.join(SF_SMALL, 'documents.parquet')}'").fetchall()
    got = {r["doc_id"]: r for r in QUERIES["op11_pii_boosting"](spark, SF_SMALL).collect()}
    assert len(got) == len(documents)
    for i, t in documents:
        base = brute.personal(t)
        r = got[i]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert r["base_sha256"] == brute.sha(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode())
        every = [tuple(x.split(":")) for x in r["spans"].split(",") if x]
        assert {(k, int(s), int(e)) for k, s, e in every} >= set(base)
        assert every == sorted(every, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))


def test_pii_of_odd_tables(spark, model):
    rows = [(1, None, "k"), (None, "mail a@b.org", "k"), (2, "", "k"), (3, "é🙂 a@b.org", "k"), (3, "é🙂 a@b.org", "k")]
    df = spark.createDataFrame(rows, "spans long, text string, kind string")
    got = [(r["spans"], r["found"]) for r in pii.find(df.withColumnRenamed("spans", "id"), model, "id").select(F.col("id").alias("spans"), pii.span_text(F.col("spans")).alias("found")).collect()]
    assert sorted(got, key=repr) == sorted([(1, ""), (None, "email:5:12"), (2, ""), (3, "email:3:10"), (3, "email:3:10")], key=repr)
    clean = pii.redact(df, model)
    assert clean.columns == df.columns and sorted(map(repr, (r["text"] for r in clean.collect()))) == sorted(map(repr, [None, "mail [EMAIL]", "", "é🙂 [EMAIL]", "é🙂 [EMAIL]"]))
    empty = df.limit(0).withColumnRenamed("spans", "doc_id")
    assert pii.train(pii.labelled(empty)) is None and pii.find(empty, None).count() == 0
    assert pii.redacted("ab 1.2.3.4 c", [{"kind": "ip", "start": 3, "end": 10}, {"kind": "card", "start": 5, "end": 8}]) == "ab [IP] c"


def test_isotonic_and_thresholds():
    x, y = pii.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0.0, 1.0, 0.0, 1.0]))
    assert list(y) == [0, 0, 0.5, 0.5, 1, 1] and list(x) == [0.1, 0.1, 0.2, 0.3, 0.4, 0.4]
    assert pii._threshold(np.array([0.6, 0.7, 0.9]), np.array([0, 1, 1]), 0.95) == 0.7
    assert pii._threshold(np.array([0.6]), np.array([0]), 0.95) == 2.0


# ---- Merkle manifest ---------------------------------------------------------------------------


def struck(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def checked(spark, rows):
    df = spark.createDataFrame(rows, FIELDS).withColumns({"rank": F.lit(1), "group": F.lit("x"), "path": F.lit(0), "digest": F.lit("y")})
    got = manifest.verify(df, tampered=F.crc32(F.col("doc_id").cast("string")) % 3 == 0).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in got)
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], brute.sha("".join(s["before"] + s["after"] for s in r["path"]).encode()), r["folded_root"]) for r in got), key=repr)


def test_op12(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, n_chars, text FROM '{os.path.join(SF_SMALL, 'documents.parquet')}'").fetchall()
    got = [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")) for r in QUERIES["op12_merkle_manifest"](spark, SF_SMALL).collect()]
    assert sorted(got, key=repr) == brute.merkle(rows, struck)


@pytest.mark.parametrize("sizes", [(1,), (8,), (9,), (1, 1), (65, 8, 1), (600,), (3,) * 9])
def test_manifest_shapes(spark, sizes):
    rows = [(k * 100_000 + i, None if i % 5 == 0 else "s", None if k == 1 else f"l{k}", i, f"Text É {i}" if i % 4 else None) for k, n in enumerate(sizes) for i in range(n)]
    assert checked(spark, rows) == brute.merkle(rows, struck)


def test_manifest_of_odd_rows(spark):
    same = (7, "s", "en", 1, "Same")
    rows = [same] * 40 + [(7, "s", "en", 1, "Other"), (None, None, None, None, None), (None, "s", "en", 0, ""), (8, "s", "é", 2, "x" * 200_000), (-3, "s", "E", 2, "A")]
    assert checked(spark, rows) == brute.merkle(rows, struck)
    empty = spark.createDataFrame([], FIELDS)
    assert manifest.verify(empty).count() == 0


def test_untampered_rows_verify(spark):
    df = spark.createDataFrame([(i, "s", "en", 1, "ABC") for i in range(30)], FIELDS)
    assert [r["verified"] for r in manifest.verify(df).collect()] == [True] * 30


# ---- whitening ---------------------------------------------------------------------------------


def plain(vectors):
    """(n, deviation by vector, eigenvalues, components, mean) over distinct integer vectors, sums exact."""
    x = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    once = np.array(sorted(set(x)), object)
    n, s = len(once), once.sum(axis=0)
    centred = n * once - s
    cov = (centred.T @ centred).astype(object)
    cov = np.array([[float(c) / n**3 for c in row] for row in cov])
    e, u = np.linalg.eigh(cov)
    return n, {v: int(((n * np.array(v, object) - s) ** 2).sum()) for v in set(x)}, e[::-1], u[:, ::-1], np.array([float(a) / n for a in s]), x


def whitened(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("component", F.lit("x")).withColumn("n", F.lit(1))
    return whitening.whiten(df, whitening.fit(df, **options)).collect()


def compare(rows, got, k):
    n, deviation, e, u, mean, x = plain([v for _, v, _ in rows])
    assert len(got) == len(rows) * k
    by_id = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        by_id.setdefault(r["vec_id"], {})[r["component"]] = (r["deviation"], r["whitened"])
    for (i, _, _), v in zip(rows, x, strict=True):
        want = (np.array(v, float) - mean) @ u[:, :k] / np.sqrt(e[:k])
        for c in range(k):
            assert by_id[i][c + 1][0] == deviation[v] and abs(by_id[i][c + 1][1]) == pytest.approx(abs(want[c]), abs=1e-6)


def test_op13(spark):
    table = spark.read.parquet(os.path.join(SF_SMALL, "embeddings.parquet")).collect()
    rows = [(r["vec_id"], [float(np.float32(c)) for c in r["embedding"]], 0) for r in table]
    compare(rows, QUERIES["op13_whitening"](spark, SF_SMALL).collect(), 16)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=5) * [50, 9, 4, 2, 1]).tolist(), 1) for i in range(40)]
    good += [(100 + i, good[0][1], 1) for i in range(30)]  # copies count once
    odd = [(200, None, 1), (201, [1.0, None, 1.0, 1.0, 1.0], 1), (202, [float("nan")] * 5, 1), (203, [float("inf"), 1.0, 1.0, 1.0, 1.0], 1), (204, [1.0], 1), (205, [], 1)]
    compare(good, whitened(spark, good + odd), 5)
    far = [(i, [1e9 * i, float(i % 7), 1e30 if i == 3 else -1.0], 1) for i in range(20)]
    got = whitened(spark, far)
    assert len({r["vec_id"] for r in got}) == 20 and all(math.isfinite(r["whitened"]) for r in got)
    assert {r["deviation"] for r in got} == {None} or all(r["deviation"] is None or r["deviation"] >= 0 for r in got)


def test_whitening_without_variance(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None, 1)]) == []
    assert whitened(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)]) == []
    assert len(whitened(spark, [(1, [1.0, 2.0], 1), (None, [3.0, 2.0], 1)])) == 2  # one component varies


def test_square_sums_are_exact():
    rng = np.random.default_rng(1)
    for top in (10, 1 << 20, 1 << 30, 1 << 31, 1 << 40, 1 << 56):
        x = rng.integers(-top, top, (50, 3))
        assert whitening.exact_square_sums(x) == [sum(int(v) ** 2 for v in x[:, k]) for k in range(3)]
    x = rng.integers(-1000, 1000, (64, 4))
    n, s = len(x), x.sum(axis=0)
    middle = np.rint(s / n).astype(np.int64)
    got = whitening.covariance(n, [int(v) for v in s - n * middle], whitening.polarised(x, middle))
    assert got == pytest.approx(np.cov(x.T, bias=True), rel=1e-12)
