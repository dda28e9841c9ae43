import random
import re

import xxhash
from llm_cases import edge_docs, edge_texts, empty_docs, prose

from tillroll.llm import simhash as S
from tillroll.llm._shared import connected


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    """Union of all pairs within 3 bits; a row's component is its smallest id."""
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


def test_fingerprints_match_the_definition():
    for _, t in edge_texts():
        if len(t or "") < 6000:
            assert S.fingerprint(t) == brute_print(t)


def test_all_links_within_three_bits_are_found(spark):
    r = random.Random(1)
    prints = set()
    for _ in range(150):
        x = r.getrandbits(64)
        prints.add(x)
        for _ in range(r.randint(0, 4)):
            y = x
            for b in r.sample(range(64), r.randint(1, 4)):
                y ^= 1 << b
            prints.add(y)
            x = r.choice((x, y))
    prints |= {0, (1 << 64) - 1, 7, 1 << 63}
    prints = sorted(prints)
    df = spark.createDataFrame([(S._signed(p),) for p in prints], "print long")
    few = S.candidates(df)
    near = {a for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 3}
    found = {x.print % (1 << 64) for x in few.collect()}
    assert near <= found
    comp = {x.node % (1 << 64): x.component for x in connected(S.links(few)).collect()}
    want = brute_components(list(range(len(prints))), prints)
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            linked = a in comp and b in comp and comp[a] == comp[b]
            assert linked == (want[i] == want[j]), (a, b)


def test_edge_rows_and_components(spark):
    docs = edge_docs(spark)
    ids, texts = zip(*edge_texts())
    prints = [S.fingerprint(t) for t in texts]
    want = sorted((i or -1, f"{p:016x}", c or -1) for i, p, c in zip(ids, prints, brute_components(ids, prints)))
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in S.simhash_components(docs).collect())
    assert got == want
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for *_, c in want if c > 0})
    assert S.simhash_components(empty_docs(spark)).count() == 0
    assert S.keep_one(empty_docs(spark)).count() == 0


def test_rows_without_an_id_keep_one_of_their_own(spark):
    docs = edge_docs(spark, [(None, "alpha beta gamma delta"), (None, "alpha beta gamma delta"), (1, "quite another text")])
    assert sorted(str(r.doc_id) for r in S.keep_one(docs).collect()) == ["1", "None"]


def test_connected_components_by_brute_force(spark):
    r = random.Random(4)
    edges = [(r.randint(-50, 50), r.randint(-50, 50)) for _ in range(60)] + [(5, 5), (None, 3), (5, 6), (5, 6)]
    edges += [(i, i + 1) for i in range(100, 160)]
    got = {x.node: x.component for x in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in list(root)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_kept(rows):
    """One row of each component: the smallest (id, nulls last; fingerprint), as (id, text)."""
    prints = [S.fingerprint(t) for _, t in rows]
    comps = brute_components(list(range(len(rows))), prints)
    best = {}
    for (i, t), p, c in zip(rows, prints, comps):
        key = (i is None, i or 0, S._signed(p))
        if c not in best or key < best[c][0]:
            best[c] = (key, i)
    return sorted(((i, c) for c, (_, i) in best.items()), key=str), comps


def test_one_id_on_several_texts(spark):
    """Three different texts under ids 1, 1, 2 are three components: all three stay."""
    texts = [prose(40, k) for k in range(3)]
    docs = edge_docs(spark, [(1, texts[0]), (1, texts[1]), (2, texts[2])])
    assert sorted(r.text for r in S.keep_one(docs).collect()) == sorted(texts)


def test_kept_rows_against_brute_force(spark):
    r = random.Random(8)
    base = [prose(r.randint(0, 60), k) for k in range(12)]
    rows = [(r.choice([None, 1, 2, 3, 4, 5, 6]), r.choice(base) + (" tail" if r.random() < 0.3 else "")) for _ in range(80)]
    rows += [(9, None), (9, None), (None, "")]
    want, comps = brute_kept(rows)
    out = S.keep_one(edge_docs(spark, rows)).collect()
    texts = {}
    for (_, t), c in zip(rows, comps):
        texts[t] = c
    assert sorted(((x.doc_id, texts[x.text]) for x in out), key=str) == want


def test_texts_stay_where_they_are(spark):
    """All rows but those on both maps pass without an exchange."""
    docs = edge_docs(spark, [(i, prose(30, i // 3)) for i in range(300)])
    out = S.keep_one(docs)
    assert out.count() == 100
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    sure = plan.split("Union")[1].split("Aggregate")[0]
    assert "strategy=broadcast" in sure and "RepartitionByExpression" not in sure
