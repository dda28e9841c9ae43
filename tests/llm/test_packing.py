import random
import zlib

import numpy as np
import pyarrow as pa
from llm_cases import edge_docs, edge_texts, empty_docs, prose
from tokenizers import Tokenizer

from tillroll.llm import packing as P
from tillroll.llm.tables import PACKING_TOKENIZER


def test_ids_are_the_librarys():
    r = random.Random(2)
    odd = ["don't we've I'M x y\x85z Ünïcödé İstanbul ßẞ", "a\x1cb \x0b\x0c", "<|endoftext|> hi", "1234 56a 7.5% '' 's ''s ?'s",
           "x" * 500, "Straße—naïve", "日本語 текст", "Ⱥb", "­²¼ ŉ ǰ ſ", "a\xa0b c​d", "ẍy", "a\x00b", None, "", " "]
    odd += ["".join(r.choice("abcdefghilmnorstu'., 0éß") for _ in range(r.randint(1, 60))) for _ in range(3000)]
    library = Tokenizer.from_file(PACKING_TOKENIZER)
    for text, ids in zip(odd, P.WordTokens(PACKING_TOKENIZER).encode(pa.array(odd))):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


def check_packed(rows, texts):
    library = Tokenizer.from_file(PACKING_TOKENIZER)
    want = []
    for i, t in texts:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i or -1, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes()))
                 for k in range(0, len(ids), 2048)]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    full = {}
    for r in rows:
        full.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in full.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return full


def test_edge_rows(spark):
    rows = P.pack_documents(edge_docs(spark), PACKING_TOKENIZER).collect()
    check_packed(rows, edge_texts())
    assert P.pack_documents(empty_docs(spark), PACKING_TOKENIZER).count() == 0
    ids = P.pack_documents(edge_docs(spark), PACKING_TOKENIZER, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in ids)


def test_few_sequences_and_several_tasks(spark):
    r = random.Random(9)
    texts = [(i, prose(r.randint(1, 500), i)) for i in range(400)]
    rows = P.pack_documents(edge_docs(spark, texts), PACKING_TOKENIZER).collect()
    full = check_packed(rows, texts)
    assert len(full) <= 1.05 * sum(r.length for r in rows) / 2048 + 1
    rows = P.pack_documents(edge_docs(spark, texts), PACKING_TOKENIZER, task_tokens=20_000).collect()
    check_packed(rows, texts)


def brute_best_fit(sizes, length, most):
    """Best fit with a bounded number of open sequences, by search."""
    free, made, out = {}, 0, []
    for s in sizes:
        fits = [f for f in free.values() if f >= s]
        if fits:
            k = [n for n, f in free.items() if f == min(fits)][-1]
        else:
            if len(free) == most:
                del free[[n for n, f in free.items() if f == min(free.values())][-1]]
            k, made = made, made + 1
            free[k] = length
        out.append(length - free[k])
        left = free.pop(k) - s
        if left:
            free[k] = left
    return out, made


def test_open_sequences_are_best_fit():
    r = random.Random(6)
    for most in (1, 2, 5, 100):
        sizes = [r.randint(1, 50) for _ in range(500)]
        seqs = P.OpenSequences(50, most)
        placed = [seqs.place(s) for s in sizes]
        want, made = brute_best_fit(sizes, 50, most)
        assert [o for _, o in placed] == want and seqs.made == made
