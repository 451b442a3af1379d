"""The registered queries on the smallest tables: SQL where there is some, else plain versions."""

import os

import base64
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

import brute
import corpus_pipeline
from brute import SF_SMALL
from tickline.llm import decontaminate, grams, ngram_join, quality_rules
from tickline.llm.oracles import ORACLE
from tickline.llm.queries import QUERIES


def rows_of(df):
    names = sorted(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{os.path.join(SF_SMALL, 'documents.parquet')}'").fetchall()


@pytest.fixture(scope="module")
def benchmark():
    return duckdb.sql(f"SELECT item_id, text FROM '{os.path.join(SF_SMALL, 'benchmark.parquet')}'").fetchall()


def leaks(documents, items):
    words = lambda t: grams.words(np.frombuffer((t or "").encode(), np.uint8), grams.PUNCTUATION)[0]
    asked = [(k, words(t)) for k, t in items]
    out = {}
    for i, t in documents:
        mine = words(t)
        for k, w in asked:
            if len(w) and (s := decontaminate.align(w, mine)[0] / (2 * len(w))) >= (decontaminate.LEAST if len(w) >= decontaminate.N else 1):
                out[i, k] = s
    return out


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF_SMALL, t + '.parquet')}'")
    got = QUERIES[name](spark, SF_SMALL)
    res = con.execute(ORACLE[name])
    columns = [d[0] for d in res.description]
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    want = sorted((tuple(r[k] for k in order) for r in res.fetchall()), key=repr)
    assert sorted(got.columns) == sorted(columns) and rows_of(got) == want


def test_op2(spark, documents):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_ngram_join"](spark, SF_SMALL).collect()}
    assert got == brute.near(documents, 4, 85)[0]


def test_op5(spark, documents):
    want = [(i, n, r, s, brute.sha(k)) for i, n, r, s, k in brute.repeated_bytes(documents, 400)]
    got = QUERIES["op5_suffix_dedup"](spark, SF_SMALL).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_op8(spark, documents, benchmark):
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in QUERIES["op8_decontamination"](spark, SF_SMALL).collect()}
    assert got == pytest.approx(leaks(documents, benchmark))


def test_op1_op4_op9_give_all_rows(spark, documents):
    found = QUERIES["op1_secret_scan"](spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in found} <= {i for i, _ in documents}
    pages = {r[0]: r[1] for r in duckdb.sql(f"SELECT page_id, html FROM '{os.path.join(SF_SMALL, 'pages.parquet')}'").fetchall()}
    got = QUERIES["op4_html_templates"](spark, SF_SMALL).collect()
    assert {r["page_id"] for r in got} == set(pages)
    for r in got:
        assert r["n_chars"] == len(r["text"]) and r["text"] == " ".join(r["text"].split())
        assert "track(" not in r["text"] and "©" not in r["text"]
    assert QUERIES["op9_sharding"](spark, SF_SMALL).count() == len(documents)


def test_pipeline(spark, documents, benchmark):
    kept = [(i, t) for i, t in documents if brute.quality(t, quality_rules.STOP_WORDS, quality_rules.RULES)[2]]
    cut = [(i, v[2]) for i, v in brute.cut_lines(kept).items()]
    spec = ngram_join.Spec()
    near = brute.near(cut, spec.n, spec.percent)[0]
    one = [(i, t) for i, t in cut if near[i][1] == i]
    bad = {i for i, _ in leaks(one, benchmark)}
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})
    want = {}
    for i, t in one:
        if i not in bad:
            ids = coder.encode_ordinary(t)
            want[i] = (len(ids), ids, brute.sha(np.asarray(ids, "<u4").tobytes()), brute.sha(t.encode()))
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want
    assert len(got) == len(want) and 0 < len(want) < len(documents)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]


def test_corpus_rules_keep_clean_documents(spark):
    line, prose = "Shared line of a site", " ".join(f"the word{k} of" for k in range(200))
    made = spark.createDataFrame([(1, f"{line}\n{prose}\n{line}"), (2, "\n".join(f"{k % 5} the same long line of many words is said and said again {k % 5}" for k in range(20)))], "doc_id long, text string")
    assert [r["doc_id"] for r in quality_rules.keep(made, rules=quality_rules.CORPUS_RULES).collect()] == [1]
    clean = (30, 3314, 3723, 9916)  # labelled 1, of sf0.1
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where(f"doc_id IN {clean}")
    assert {r["doc_id"] for r in quality_rules.keep(docs, rules=quality_rules.CORPUS_RULES).collect()} == set(clean)


def test_templates_are_counted_by_pages(spark):
    """Templates and texts of the given pages, and of some that repeat a block, against counts in Python."""
    from collections import defaultdict

    from tickline.llm import html

    pages = duckdb.sql(f"SELECT url, html FROM '{os.path.join('/root/testdata/sf0.01', 'pages.parquet')}'").fetchall()
    step = "<div><p>Wait for ten minutes.</p></div>"
    pages += [(f"http://five.example/{k}", f"<article><h1>Bread {k}</h1>{''.join(f'<p>Step {k} {j}</p>{step if k == 0 else str()}' for j in range(5))}</article>") for k in range(5)]
    pages += [(f"http://big.example/{k}", f"<body><b>Menu</b><article><h2>Often said</h2><p>Story {k} of its own, long enough</p>{'<p>Then they slept.</p>' if k % 3 == 0 else ''}<div>Share</div></article></body>") for k in range(40)]
    parents, whole = defaultdict(set), defaultdict(set)
    host = lambda u: u.split("//", 1)[1].split("/")[0].lower()
    for u, h in dict.fromkeys(pages):
        page, found = html.subtrees(h)
        whole[host(u)].add(page)
        for x, p in found:
            parents[host(u), x].add(p)
    least = lambda n: max(min(html.LEAST_PAGES, max(html.SMALL_LEAST, -(-n // 2))), n * html.SHARE)
    want = []
    for u, h in pages:
        n = len(whole[host(u)])
        seen = {x: len(parents[host(u), x]) for x, _ in html.subtrees(h)[1]}
        often = frozenset(x for x, k in seen.items() if k >= least(n))
        inside = frozenset(x for x in often if seen[x] >= max(html.SMALL_LEAST, -(-n // 2)))
        want.append((u, html.text_of(html.blocks(h), often, inside)))
    got = html.extract(spark.createDataFrame(pages, "url string, html string").repartition(3))
    assert sorted((r["url"], r["text"]) for r in got.collect()) == sorted(want)
    text = dict(want)
    assert text["http://five.example/0"].count("Wait for ten minutes.") == 5
    assert text["http://big.example/3"] == "Story 3 of its own, long enough Then they slept."
