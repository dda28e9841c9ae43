import collections
import random
import re

import pytest
from llm_cases import edge_docs, edge_texts, empty_docs
from pyspark.sql import functions as F

from tillroll.llm import collocations as C


def brute(rows, max_words=5, min_count=3, top=2000, percent=100):
    counts, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang] += len(words)
            counts.update((lang, words[i:i + n]) for n in range(1, max_words + 1) for i in range(len(words) - n + 1))
    frequent = {p: f for p, f in counts.items() if f >= min_count}
    gone = {(lang, p[i:i + n]) for (lang, p), f in frequent.items() for n in range(2, len(p))
            for i in range(len(p) - n + 1) if 100 * f >= percent * frequent[lang, p[i:i + n]]}
    out = collections.defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) < 2 or (lang, p) in gone:
            continue
        score, k = min((1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], total[lang]))
    return sorted((lang, rank, p.decode(), -a, le, r, n, -s) for lang, found in out.items()
                  for rank, (s, a, p, le, r, n) in enumerate(sorted(found)[:top], 1))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def random_rows(seed, n=60):
    r = random.Random(seed)
    words = ["a", "B", "the", "of\x01", "é", "the-x", "Zz", "日本", "a\x0b", "of"]
    ends = [" ", "  ", "\t", ". ", ", ", "\n", " ; "]
    weights = [12, 2, 2, 1, 1, 1, 1]
    return [(r.choice(["en", "en", "fr", None, ""]),
             "".join(r.choice(words) + r.choices(ends, weights)[0] for _ in range(r.randint(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(C, "RANGE_ROWS", 40)               # many borders, so that paths cross them
    rows = random_rows(seed)
    percent = (100, 80, 60)[seed]
    got = C.collocations(frame(spark, rows), min_count=3, top=25, percent=percent)
    assert sorted(map(tuple, got.collect())) == brute(rows, top=25, percent=percent)


def test_a_full_map_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "MAX_MAP_BITS", 10)
    monkeypatch.setattr(C, "BITS_PER_PHRASE", 1)
    rows = random_rows(7)
    assert sorted(map(tuple, C.collocations(frame(spark, rows), min_count=2).collect())) == brute(rows, min_count=2)


def test_hot_first_word_spans_ranges(spark, monkeypatch):
    """One word begins a third of all phrases: its phrases lie in several ranges and still find their parts."""
    monkeypatch.setattr(C, "RANGE_ROWS", 20)
    rows = [("en", " . ".join(f"the w{i} x{i % 7}" for i in range(60)))] * 3
    dealt = C._stream(C.frequent_phrases(frame(spark, rows), min_count=3), False, 8, 1)
    parts = dealt.where("f is not null and phrase like 'the %'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1
    assert sorted(map(tuple, C.collocations(frame(spark, rows), min_count=3).collect())) == brute(rows)


def test_products_beyond_64_bits():
    import pyarrow as pa
    n, a, part = 9 * 10 ** 17, 10 ** 15, 4 * 10 ** 15
    batch = pa.RecordBatch.from_arrays([pa.array([x]) for x in ("en", "a b", a, [n, part], [n, part], 0)], list("abcdef"))
    (got,) = next(C._score(100, [batch])).to_pylist()
    assert got["score"] == 1000 * a * n // (part * part)


def test_edge_rows(spark):
    """Nulls in any column, empty and very long texts, copies, clashing names, an empty table."""
    docs = edge_docs(spark).withColumn("phrase", F.lit("clash")).withColumn("f", F.lit(None).cast("long"))
    rows = [(r.lang, r.text) for r in docs.collect()]
    assert len(rows) == len(edge_texts())
    assert sorted(map(tuple, C.collocations(docs, min_count=2).collect())) == brute(rows, min_count=2)
    assert C.collocations(empty_docs(spark)).collect() == []
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert C.collocations(docs.where("text is null")).columns == columns
