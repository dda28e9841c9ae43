import hashlib
import random
import re

from llm_cases import WORDS, edge_docs, edge_texts, empty_docs

from tillroll.llm import decontaminate as D

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(text, items):
    """(n_words, n_hit, items) by trying every window at every place."""
    words = PATTERN.findall(low(text))
    hit, found = set(), set()
    for i, t in items:
        w = PATTERN.findall(low(t))
        if not w:
            continue
        for k in range(max(1, len(w) - 9)):
            win = w[k:k + 10]
            for at in range(len(words) - len(win) + 1):
                if words[at:at + len(win)] == win:
                    hit.update(range(at, at + len(win)))
                    found.update([] if i is None else [str(i)])
    return len(words), len(hit), sorted(found)


def cases():
    r = random.Random(8)
    items = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(1, 25)))) for i in range(10, 40)]
    items += [(1, "same, SAME same"), (2, None), (3, ""), (None, "river stone"), (4, "éa ñb"), (5, items[0][1]),
              (5, items[0][1]), (6, "?!")]
    docs = [(i, t) for i, t in edge_texts() if len(t or "") < 6000]
    for i in range(120):
        t = " ".join(r.choice(WORDS) for _ in range(r.randint(0, 60)))
        if i % 3 == 0:
            t += ".\n\t" + r.choice(items[:30])[1].upper()
        docs.append((100 + i, t))
    docs.append((900, "ÉA ñb éa Ñb éa-ñb"))
    return docs, items


def test_against_brute_force_with_one_and_several_automata(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, t in docs:
        n, h, found = brute(t, items)
        want.append((i or -1, n, h, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), h > 0))
    assert any(w[2] for w in want) and not all(w[2] for w in want)
    for max_keys in (D.MAX_KEYS, 40):
        out = D.decontaminate(edge_docs(spark, docs), bench, max_keys=max_keys).collect()
        got = [(r.doc_id or -1, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in out]
        assert sorted(got) == sorted(want)
        texts = dict(docs)
        for r in out:                                    # spans lie in the original text
            if r.doc_id is not None and r.spans:
                cut = [PATTERN.findall(low(texts[r.doc_id][s.start:s.end])) for s in r.spans]
                assert sum(map(len, cut)) == r.n_hit


def test_dropped_rows_and_empty_tables(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = edge_docs(spark, docs)
    clean = D.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    assert clean.count() == sum(not brute(t, items)[1] for _, t in docs)
    assert D.decontaminate(empty_docs(spark), bench).count() == 0
    assert D.decontaminate(df, bench.where("false")).where("contaminated").count() == 0


def test_spelling_keeps_words_apart():
    words = [b"w%d" % i for i in range(300)]
    w = D.Windows([(tuple(words[i:i + 2]), [str(i)]) for i in range(299)])
    assert w.places == 2
    spans, items = w.scan([words[7], words[8], b"other", words[9], words[8]])
    assert spans == [(0, 2)] and items == {"7"}
