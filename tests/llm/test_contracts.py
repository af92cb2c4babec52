"""Registered queries against SQL and plain Python on the driver tables."""

import hashlib
import html
import re
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]
SF = Path("/root/testdata/sf0.001")
sys.path.insert(0, str(ROOT / "tools"))

import check_oracle  # noqa: E402

from lumentab.llm import queries  # noqa: E402

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not mounted")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in check_oracle.TABLES + [x for x in ("pages", "benchmark", "labels", "conversations", "embeddings") if x not in check_oracle.TABLES]:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def rows(frame):
    columns = sorted(frame.columns)
    # By their text, as a row may hold null.
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr), columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    got, columns = rows(queries.QUERIES[name](spark, str(SF)))
    want = con.sql(queries.ORACLES[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(r[k] for k in order) for r in want.fetchall()), key=repr)


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_token_counts(spark, tokenizer):
    texts = {r.doc_id: r.text for r in queries.table(spark, str(SF), "documents").collect()}
    for r in queries.op6_token_counts(spark, str(SF)).collect():
        n = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_token_file(spark, tokenizer):
    texts = {r.doc_id: r.text for r in queries.table(spark, str(SF), "documents").collect()}
    got = {r.doc_id: r for r in queries.op9_token_file(spark, str(SF)).collect()}
    assert len(got) == len(texts)
    start = 0
    for i in sorted(texts):
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def article(page):
    """The blocks of the article, read off the generated pages: text between tags, references resolved."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_pages(spark):
    pages = {r.page_id: r for r in queries.table(spark, str(SF), "pages").collect()}
    for r in queries.op2_extract(spark, str(SF)).collect():
        assert r.text == article(pages[r.page_id].html)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()}
    got = queries.op3_language(spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    fresh = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert len(fresh) > 100
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in fresh) >= 0.97 * len(fresh)


def test_mixture_meets_its_limits(spark):
    docs = queries.table(spark, str(SF), "documents").collect()
    got = queries.op10_mixing(spark, str(SF)).collect()
    assert {r.doc_id for r in got} == {d.doc_id for d in docs}
    total, mixed = {}, {}
    for d in docs:
        total[d.source] = total.get(d.source, 0) + len(d.text.split())
    for r in got:
        mixed[r.source] = mixed.get(r.source, 0) + r.n_tokens
    assert max(mixed[s] / total[s] for s in total) <= 2.0
    assert max(r["pass"] for r in got) <= 2


def test_pipeline_keeps_what_it_should(spark):
    import corpus_pipeline
    from lumentab.llm import decontaminate, ngramjoin, quality

    docs = queries.table(spark, str(SF), "documents")
    left = quality.filter_documents(docs)
    assert left.columns == docs.columns
    judged = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert {r.doc_id for r in left.collect()} == {i for i, k in judged.items() if k}
    one = ngramjoin.keep_one(left, width=5, percent=80)
    groups = {r.doc_id: r.component_id for r in ngramjoin.jaccard_components(left, width=5, percent=80).collect()}
    assert sorted(r.doc_id for r in one.collect()) == sorted({*groups.values()})
    clean = corpus_pipeline.benchmark_stage(spark, one, str(SF))
    marked = {r.doc_id for r in decontaminate.contamination(one, queries.table(spark, str(SF), "benchmark")).where("contaminated").collect()}
    assert {r.doc_id for r in clean.collect()} == {*groups.values()} - marked
    assert len(corpus_pipeline.STAGES) == 5
    final = corpus_pipeline.run(spark, str(SF)).collect()
    assert {r.doc_id for r in final} == {*groups.values()} - marked
    assert sum(r.n_tokens for r in final) == max(r.start + r.n_tokens for r in final)


def test_digest_of_no_item():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
