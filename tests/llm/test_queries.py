"""The registered queries over whole tables, against SQL or brute force."""

import collections
import hashlib
import re

import duckdb
import pytest
import sentencepiece
import test_packing
import test_secret_scan
import test_url_templates
from test_simhash import brute_components, brute_print

import __spark_entry__ as E
from tillroll.llm.oracle import SQL
from tillroll.llm.quality_rules import text_counts
from tillroll.llm.queries import QUERIES
from tillroll.llm.tables import COUNTING_MODEL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_one_query_for_each_operator():
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(QUERIES)
    numbers = [q.split("_")[0] for q in QUERIES]
    assert sorted(numbers) == sorted([f"op{n}" for n in range(1, 14)] + ["pipeline"])


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    want = con.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())


def test_op1_finds_every_shared_passage(spark, docs):
    out = rows(spark, "op1_substring_dedup")
    where = collections.defaultdict(set)
    for d, t in docs.items():
        for line in (t or "").split("\n"):
            words = line.lower().split()
            for n in (20, 51):
                for i in range(len(words) - n + 1):
                    where[n, tuple(words[i:i + n])].add(d)
    shared = {n: {d for (k, _), ds in where.items() if k == n and len(ds) > 1 for d in ds} for n in (20, 51)}
    found = {r.doc_id for r in out}
    assert shared[51] <= found <= shared[20]
    assert all(0 <= r.start < r.stop <= len(docs[r.doc_id]) for r in out)


def test_op2_base_columns(spark, docs):
    for r in rows(spark, "op2_quality_rules"):
        n = text_counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n[:5]
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and not (r.base_failed and r.kept)


def test_op3_components(spark, docs):
    ids = sorted(docs)
    prints = [brute_print(docs[i]) for i in ids]
    want = [(i, f"{p:016x}", c) for i, p, c in zip(ids, prints, brute_components(ids, prints))]
    assert sorted(map(tuple, rows(spark, "op3_simhash"))) == want


def test_op5_pieces(spark, docs):
    full = test_packing.check_packed(rows(spark, "op5_best_fit_packing"), [(i or -1, t) for i, t in docs.items()])
    assert len(full) > 1


def test_op6_rules(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    out = rows(spark, "op6_url_filter")
    assert len(out) == len(urls)
    for r in out:
        host, path, rule = test_url_templates.brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == test_url_templates.RULES[rule] if rule else r.verdict in ("allow", "block")


def test_op7_articles_are_the_documents_shown(spark, docs):
    out = rows(spark, "op7_html_text")
    assert len(out) == spark.read.parquet(f"{SF}/pages.parquet").count()
    for r in out:
        shown = int(re.findall(r"\d+", r.url.split("://")[1].split("?")[0].split("#")[0])[-1])
        want = [" ".join(line.split()) for line in docs[shown].split("\n") if line.strip()]
        assert r.text.split("\n")[1:] == want and r.n_chars == len(r.text)     # behind the heading


def test_op8_base_spans(spark, docs):
    for r in rows(spark, "op8_secret_scan"):
        base = test_secret_scan.brute(docs[r.doc_id])
        said = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in base) for k in range(3))


def test_op9_counts(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    for r in rows(spark, "op9_token_counts"):
        n = len(library.encode(docs[r.doc_id] or ""))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len((docs[r.doc_id] or "").encode()), n > 4096)
