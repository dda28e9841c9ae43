import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import edge_docs, edge_texts, empty_docs
from pyspark.sql import functions as F

from tillroll.llm import toxicity as T

SF = "/root/testdata/sf0.01"
BAD = ["moron", "scum", "pathetic", "clown"]
LABELS = "doc_id long, toxic int"


def plain(n, seed):
    r = random.Random(seed)
    words = "morning river the paper window of people stone light garden almost never house a seven colour letter".split()
    return " ".join(r.choice(words) + r.choice(["", "", ",", "."]) for _ in range(n))


def insult(text, seed, disguise=lambda w: w):
    r = random.Random(seed)
    words = text.split()
    for _ in range(max(2, len(words) // 20)):
        words.insert(r.randrange(len(words) + 1), disguise(r.choice(BAD)))
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, insult(plain(60, i), i) if i % 6 == 0 else plain(60, i)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows], LABELS)
    return rows, docs, labels, T.fit_toxicity(docs, labels)


def path_cost(decoder, letters):
    total, x, y = 0.0, T.EDGE, T.EDGE
    for c in letters + " ":
        z = T._symbol(c)
        if z == y == T.EDGE:
            continue
        total += decoder.costs[(x << 2 * T.BITS) | (y << T.BITS) | z]
        x, y = (T.EDGE, T.EDGE) if z == T.EDGE else (y, z)
    return total


@pytest.mark.parametrize("token, spaced", [("m0r0n", 0), ("1d10t", 0), ("paatheetic", 0), ("s c u m", 1), ("sccc*m!", 0),
                                           ("c.1.0.w.n", 1), ("(a)", 0), ("ééé4", 0), ("ab", 0)])
def test_viterbi_finds_the_cheapest_path(corpus, token, spaced):
    decoder = T.Decoder(corpus[3].costs)
    steps = T.lattice(token, bool(spaced))
    every = [("".join(o[0] for o in way), sum(o[1] for o in way)) for way in itertools.product(*steps)]
    best = min(path_cost(decoder, text) + cost for text, cost in every)
    got = decoder.viterbi(steps)
    assert min(path_cost(decoder, t) + c for t, c in every if t == got) == pytest.approx(best, abs=1e-4)


def test_spots_equal_the_whole_token(corpus):
    """Decoding spot by spot gives a path as cheap as decoding the token at once."""
    r, decoder = random.Random(5), T.Decoder(corpus[3].costs)
    for _ in range(400):
        token = "".join(r.choice(["a", "n", "o", "oo", "0", "1", "r", "w", "ss", "3", "p", ".", "é", "sss"])
                        for _ in range(r.randint(1, 9)))
        if sum(map(token.count, T.SEPARATORS)) > 2 or not any(c.isalpha() for c in token):
            continue
        whole, spots = decoder.viterbi(T.lattice(token)), decoder.token(token)
        if whole != spots:
            cost = [min(c for t, c in ways(token) if t == s) for s in (whole, spots)]
            assert path_cost(decoder, whole) + cost[0] == pytest.approx(path_cost(decoder, spots) + cost[1], abs=1e-3), (token, whole, spots)


def ways(token):
    return [("".join(o[0] for o in way), sum(o[1] for o in way)) for way in itertools.product(*T.lattice(token))]


def test_character_model_counts_all_texts(spark):
    """Against plain counting, whatever the partitions."""
    texts = ["Ab, ab!", "", None, "é1 日本"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {}
    for parts in (1, 5):
        for b in df.repartition(parts).mapInArrow(T._trigrams, "at int, n long").collect():
            got.setdefault(parts, {}).setdefault(b.at, 0)
            got[parts][b.at] += b.n
    want = {}
    for t in texts:
        s = []
        for c in (t or "").lower():
            s.append(T._symbol(c))
        words = "".join(chr(x + 1) for x in s).split(chr(1))
        for w in words:
            padded = [0, 0, *(ord(c) - 1 for c in w), 0, 0] if w else []
            for a, b, c in zip(padded, padded[1:], padded[2:]):
                if (b, c) != (0, 0):
                    want[a << 12 | b << 6 | c] = want.get(a << 12 | b << 6 | c, 0) + 1
    for parts in got:
        assert {k: n for k, n in got[parts].items() if k & 0xFFF} == want


def test_feature_counts_equal_brute_force(corpus):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["morning", "an", "scum", "riverside", "no"], k=rng.randint(0, 8))) for _ in range(50)]
    labels = [rng.randint(0, 1) for _ in texts]

    class Costs:
        value = corpus[3].costs
    got = {}
    for b in T._counts(Costs, [pa.RecordBatch.from_arrays([pa.array(texts + [None]), pa.array(labels + [1])], ["t", "y"])]):
        for f, x, y in zip(*(c.to_pylist() for c in b.columns)):
            got[f] = (got.get(f, (0, 0))[0] + x, got.get(f, (0, 0))[1] + y)
    want = {}
    for t, y in zip(texts, labels):
        for f in {f for w in t.split() for f in T.features([w])[0].tolist()}:
            a, b = want.get(f, (0, 0))
            want[f] = (a + y, b + 1 - y)
    assert got == want


def test_features_hold_word_and_grams():
    hashed, owner = T.features(["scum", "a", "clowns"])
    padded = [len(w) + 2 for w in ("scum", "a", "clowns")]
    assert np.bincount(owner).tolist() == [1 + max(0, n - 3) + max(0, n - 4) for n in padded]
    shared = set(T.features(["clown"])[0].tolist()) & set(hashed[owner == 2].tolist())
    assert len(shared) == 3 + 2                            # ^clo clow lown, ^clow clown


DISGUISES = {"leet": lambda w: w.translate(str.maketrans("oaiesc", "04135(")), "spaces": " ".join, "dots": ".".join,
             "repeats": lambda w: w[:2] + 3 * w[2] + w[3:-1] + 4 * w[-1], "plain": lambda w: w.upper(),
             "mixed": lambda w: "-".join(w.replace("o", "0"))}


@pytest.mark.parametrize("name", sorted(DISGUISES))
def test_disguised_insults_are_found(spark, corpus, name):
    disguise = DISGUISES[name]
    toxic = [(1000 + i, insult(plain(80, 5000 + i), i, disguise)) for i in range(40)]
    clean = [(2000 + i, plain(80, 7000 + i).replace("river", disguise("river"))) for i in range(40)]
    out = {r.doc_id: r for r in T.score_toxicity(spark.createDataFrame(toxic + clean, "doc_id long, text string"),
                                                 corpus[3]).collect()}
    assert sum(out[i].predicted for i, _ in toxic) >= 38
    assert sum(out[i].predicted for i, _ in clean) == 0


def test_held_out_accuracy_on_the_tables(spark):
    from tillroll.llm.queries import QUERIES
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = QUERIES["op13_toxicity"](spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    tested = [(labels[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in tested) >= 0.95 * len(tested) and len(tested) > 50


def test_held_out_labels_do_not_matter(spark, corpus):
    rows, docs, labels, model = corpus
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = T.fit_toxicity(docs.repartition(7), turned)
    assert (again.toxic, again.clean) == (model.toxic, model.clean)
    assert np.array_equal(again.features, model.features) and np.allclose(again.weights, model.weights)


def test_copies_count_once(spark, corpus):
    rows, docs, labels, model = corpus
    train = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    more = [(10_000 + k, train[0][1]) for k in range(200)]
    both = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    marks = labels.union(spark.createDataFrame([(i, int(train[0][0] % 6 == 0)) for i, _ in more], LABELS))
    again = T.fit_toxicity(both, marks)
    assert (again.toxic, again.clean) == (model.toxic, model.clean)


def test_edge_rows(spark, corpus):
    """Nulls, empty and long texts, copies, clashing names, empty tables, no labels, labels of one kind."""
    docs = edge_docs(spark).withColumn("toxic", F.lit("clash")).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 1), (1, None), (6, 0), (None, 1), (9, None), (3, 1), (4, 0)], LABELS)
    for marks in (labels, labels.where("toxic = 0"), labels.where("false")):
        out = T.score_toxicity(docs, T.fit_toxicity(docs, marks)).collect()
        assert len(out) == len(edge_texts()) and all(0 <= r.score <= 1 for r in out)
        scores = {}
        for r, (i, t) in zip(sorted(out, key=lambda r: (r.doc_id or -1, r.score)), sorted(edge_texts(), key=lambda x: x[0] or -1)):
            scores.setdefault(t or "", set()).add(round(r.score, 12))
        assert all(len(s) == 1 for s in scores.values())
        assert all(r.held_out is False for r in out if r.doc_id is None)
    model = T.fit_toxicity(empty_docs(spark), labels.where("false"))
    assert T.score_toxicity(empty_docs(spark), model).collect() == []
    assert T.score_toxicity(docs, corpus[3]).columns == ["doc_id", "held_out", "score", "predicted"]
