import random

import sentencepiece
from llm_cases import edge_docs, edge_texts, empty_docs

from tillroll.llm import token_fst as T
from tillroll.llm.tables import COUNTING_MODEL


def odd_texts():
    r = random.Random(5)
    out = ["", " ", "  ", "a  b   c    d", "aaaaaaaaaaaa" * 150, "\n\n\n\t x", "日本語のテキスト 🎉🎉 zażółć",
           "<s> </s> <unk> <0x0A>", "a\x00b", " leading", "trailing ", "   " * 700, "▁▁ ▁a", "x" * 3000, "ab" * 1500,
           "1234567890" * 200, "don't 'ere", "é́", None]
    out += ["".join(r.choice("abcdeé ñ  \n.,xyzth") for _ in range(r.randint(1, 1500))) for _ in range(60)]
    out += ["".join(r.choice("ab ") for _ in range(r.randint(1, 1200))) for _ in range(60)]
    return out


def test_counts_are_the_librarys():
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    machine = T.Transducer(COUNTING_MODEL)
    texts = odd_texts()
    assert machine.count(texts).tolist() == [len(library.encode(t or "")) for t in texts]


def test_chunk_maps_compose_where_the_guess_is_wrong(monkeypatch):
    """With hardly any warm-up most entry states are guessed wrongly; the scan has to mend them."""
    monkeypatch.setattr(T, "CHUNK", 8)
    monkeypatch.setattr(T, "WARM_UP", 1)
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    machine = T.Transducer(COUNTING_MODEL)
    texts = [t[:300] if t else t for t in odd_texts()]
    assert machine.count(texts).tolist() == [len(library.encode(t or "")) for t in texts]


def test_long_texts_that_do_not_synchronise_take_few_runs(monkeypatch):
    """Equal chunks share their maps, and maps compose in a logarithmic number of steps."""
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    machine = T.Transducer(COUNTING_MODEL)
    lanes, run = [], machine.run
    monkeypatch.setattr(machine, "run", lambda s, *a: (lanes.append(len(s)), run(s, *a))[1])
    texts = ["a" * 200_000, "-" * 150_001, "ab" * 60_000]
    assert machine.count(texts).tolist() == [len(library.encode(t)) for t in texts]
    assert len(lanes) < 60


def test_too_many_states_are_run_one_by_one(monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 8)
    monkeypatch.setattr(T, "WARM_UP", 1)
    monkeypatch.setattr(T, "MOST_LANES", 3)
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    machine = T.Transducer(COUNTING_MODEL)
    texts = [t[:200] if t else t for t in odd_texts()][:60]
    assert machine.count(texts).tolist() == [len(library.encode(t or "")) for t in texts]


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(T, "MOST_TRANSITIONS", 50)
    machine = T.Transducer(COUNTING_MODEL)
    first = machine.count(["some words here and there"]).tolist()
    assert machine.count(["other things altogether, quite different"]).sum() > 0
    assert machine.count(["some words here and there"]).tolist() == first


def test_edge_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=COUNTING_MODEL)
    out = T.count_tokens(edge_docs(spark), COUNTING_MODEL).collect()
    want = sorted((i or -1, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in edge_texts())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in out) == want
    assert any(w[3] for w in want)
    assert T.count_tokens(empty_docs(spark), COUNTING_MODEL).count() == 0
