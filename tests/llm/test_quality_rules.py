import math
import random

from llm_cases import edge_docs, edge_texts, empty_docs
from pyspark.sql import functions as F

from tillroll.llm import quality_rules as Q


def brute(text):
    """The base counts by their definition."""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    cover = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1 if len(windows) < 400 else False:
            cover.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover))


def test_counts_match_the_definition():
    r = random.Random(7)
    texts = [t for _, t in edge_texts() if len(t or "") < 3000]
    texts += ["".join(r.choice("ab #|\n\t\x0b ") for _ in range(r.randint(0, 300))) for _ in range(200)]
    texts += ["\x85a\xa0b c d", "a\x1cb c"]
    for t in texts:
        assert Q.text_counts(t)[:5] == brute(t), t


def test_long_texts_take_ranks_not_tuples():
    words = [b"w%d" % (i % 25_000) for i in range(30_000)]
    assert Q.repeated_words(words) == 2 * 5_000
    assert Q.repeated_words([b"w%d" % i for i in range(30_000)]) == 0


def test_upper_bound_is_clopper_pearson():
    assert abs(Q.upper_bound(0, 100, 0.05) - (1 - 0.05 ** 0.01)) < 1e-9
    for k, n in ((3, 50), (10, 400)):
        p = Q.upper_bound(k, n, 0.01)
        assert abs(sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)) - 0.01) < 1e-6
    assert Q.upper_bound(5, 5, 0.05) == 1.0 and Q.upper_bound(0, 0, 0.05) == 1.0


def corpus(spark, n=3000):
    """Good rows are prose; bad ones carry symbols.  Stratum 'de' has too few labels to certify anything."""
    r = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        bad, lang = i % 5 == 0, "de" if i % 100 == 1 else "en"
        words = [f"w{r.randint(0, 10 ** 6)}" + ("***" if bad else "") for _ in range(30)]
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(not bad), 0))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_cutoffs_are_certified_per_stratum_and_reject_the_bad(spark):
    docs, labels = corpus(spark)
    counts = Q.quality_counts(docs)
    cutoffs = Q.choose_cutoffs(counts, Q.good_labels(labels)).collect()
    assert {c["stratum"] for c in cutoffs} == {"en"}          # 30 labelled rows of 'de' prove nothing
    tests = 2 * sum(len(r.cutoffs) for r in Q.RULES)
    for c in cutoffs:
        assert c.bound <= 0.05 / len(Q.RULES)
        assert abs(c.bound - Q.upper_bound(c.false_rejects, c.n_good, 0.05 / tests)) < 1e-12
    out = {r.doc_id: r.kept for r in Q.quality_rules(docs, labels).collect()}
    assert all(out[i] == (i % 5 != 0) for i in out if i % 100 != 1)
    kept = Q.keep_quality(docs, labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, k in out.items() if k}


def test_nothing_is_certified_where_good_rows_would_go(spark):
    docs, labels = corpus(spark)
    noise = labels.withColumn("quality", F.when(F.col("doc_id") % 3 == 0, 1).otherwise(0))
    counts = Q.quality_counts(docs)
    assert Q.choose_cutoffs(counts, Q.good_labels(noise)).count() == 0


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = edge_docs(spark)
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.base_failed, r.kept)
                 for r in Q.quality_rules(docs, labels).collect())
    want = []
    for i, t in edge_texts():
        n = Q.text_counts(t)
        failed = n[0] < 10 or 100 * n[4] > 20 * n[0]
        want.append((i or -1, *n[:4], failed, not failed))
    assert got == sorted(want)
    kept = Q.keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(w[-1] for w in want)
    assert Q.quality_rules(empty_docs(spark), labels).count() == 0
    assert Q.keep_quality(empty_docs(spark), labels).count() == 0
    assert Q.quality_rules(docs, labels.where("false")).where("kept = base_failed").count() == 0


def test_copies_certify_nothing(spark):
    """60 good texts are too few; the same texts a hundred times over, under one id or many, are no more."""
    texts = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(60)]
    bad = [" ".join(f"b{k}x{i}***" for i in range(30)) for k in range(20)]
    few = [(k, t, "en") for k, t in enumerate(texts + bad)]
    labels = [(k, int(k < 60), 0) for k in range(80)]
    schema, marks = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"
    assert Q.choose_cutoffs(Q.quality_counts(spark.createDataFrame(few, schema)),
                            Q.good_labels(spark.createDataFrame(labels, marks))).count() == 0
    copies = few * 50 + [(1000 * c + k, t, lang) for c in range(1, 51) for k, t, lang in few]
    more = labels + [(1000 * c + k, q, x) for c in range(1, 51) for k, q, x in labels]
    counts = Q.quality_counts(spark.createDataFrame(copies, schema))
    assert Q.choose_cutoffs(counts, Q.good_labels(spark.createDataFrame(more, marks))).count() == 0


def test_cutoffs_against_brute_force(spark):
    """All strata, rules and cutoffs by hand: which are allowed, and which of them is taken."""
    docs, labels = corpus(spark)
    rows = {r.doc_id: r for r in Q.quality_counts(docs).collect()}
    good = {r.doc_id: r.good for r in Q.good_labels(labels).collect()}
    held = {}
    for i, r in rows.items():
        if i in good and not (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words):
            held[r.stratum, r.digest] = (r, min(good[i], held.get((r.stratum, r.digest), (r, 1))[1]))
    strata = {s for s, _ in held}
    tests = len(strata) * sum(len(r.cutoffs) for r in Q.RULES)
    want = {}
    frame = Q.quality_counts(docs).withColumn("all", F.lit(1))
    for rule in Q.RULES:
        for c in rule.cutoffs:
            hit = {x.doc_id for x in frame.where(rule.rejects(F.lit(c))).select("doc_id").collect()}
            for s in strata:
                mine = [(r, g) for (t, _), (r, g) in held.items() if t == s]
                n_good = sum(g for _, g in mine)
                k = sum(g for r, g in mine if r.doc_id in hit)
                bad = sum(1 - g for r, g in mine if r.doc_id in hit)
                gain = bad - 10.0 * k
                if gain > 0 and Q.upper_bound(k, n_good, 0.05 / tests) <= 0.05 / len(Q.RULES):
                    if (s, rule.name) not in want or gain > want[s, rule.name][0]:
                        want[s, rule.name] = (gain, c)
    got = {(c.stratum, c.rule): c.cutoff for c in Q.choose_cutoffs(Q.quality_counts(docs), Q.good_labels(labels)).collect()}
    assert got == {k: c for k, (_, c) in want.items()} and got
