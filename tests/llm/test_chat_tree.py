import hashlib
import random

from pyspark.sql import functions as F

from tillroll.llm import chat_tree as C
from tillroll.llm.queries import PROBE
from tillroll.llm.tables import CHAT_RANKS, CHAT_SPLIT

ODD = [PROBE, "", None, "\\", "\\\\h", "####", "### user: hi</turn>\n", "</turn", ">", "<</turn>>", "é日本🎉\n", "a:b", " "]


def chats():
    r = random.Random(12)
    out = []
    first = [("system", "be kind"), ("user", "hello " * 5)]
    for c in range(40):
        turns = list(first[:r.randint(0, 2)])
        for _ in range(r.randint(0 if turns else 1, 6)):
            turns.append((r.choice(["user", "assistant", "tool:x", "", None, "### a"]), r.choice(ODD)))
        out += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    copies = [(i, role, text) for c, i, role, text in out if c == 3]
    out += [(100 + k, i, role, text) for k in range(30) for i, role, text in copies]
    out += [(200, i, "assistant" if i % 2 else "user", f"turn {i} " * 3) for i in range(400)]
    out += [(201, 0, "user", "same turn"), (201, 0, "user", "same turn"), (201, 0, "assistant", "tie"), (201, None, "user", "x")]
    out += [(None, 0, "user", "no id"), (None, 1, "assistant", "none"), (-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)]
    return out


def brute(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns = [(r, x) for *_, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest(), sum(len("".join(C.segments(r, x))) for r, x in turns), turns)
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("node", "parent", "depth", "path", "leaf", "rank", "offset"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_escaping_is_reversible_and_hides_control_strings():
    r = random.Random(3)
    bits = ["\\", "#", "###", "</turn>", "<", "/turn>", ":", "h", "e", "\n", " "]
    for _ in range(4000):
        text, role = ("".join(r.choice(bits) for _ in range(r.randint(0, 9))) for _ in range(2))
        shown = C.escape(text)
        assert C.OPEN not in shown and C.CLOSE not in shown and C.unescape(shown) == text
        assert C.parse("".join(C.segments(role, text)) * 2) == [(role, text)] * 2


def test_conversations_read_back(spark):
    rows = chats()
    nodes, paths, members = C.format_tree(frame(spark, rows), CHAT_RANKS, CHAT_SPLIT)
    want = brute(rows)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars)
           for r in C.read_back(nodes, paths, members, CHAT_RANKS, CHAT_SPLIT).collect()}
    assert got == {c: v[:5] for c, v in want.items()}


def test_each_prefix_once_depth_first_with_its_ancestors(spark):
    rows = chats()
    nodes, paths, members = C.format_tree(frame(spark, rows), CHAT_RANKS, CHAT_SPLIT)
    nodes = {bytes(n.node): n for n in nodes.collect()}
    prefixes = {tuple(turns[:k]) for *_, turns in brute(rows).values() for k in range(1, len(turns) + 1)}
    assert len(nodes) == len(prefixes)
    stream = sorted(nodes.values(), key=lambda n: n.offset)
    at, line = 0, []
    for n in stream:                                     # gapless; a node follows its parent's subtree so far
        assert n.offset == at and len(n.ids) == n.n_tokens
        at += n.n_tokens
        while line and line[-1] != bytes(n.parent):
            line.pop()
        assert (line[-1] if line else b"") == bytes(n.parent) and len(line) == n.depth
        above = [nodes[a] for a in line]
        assert n.position == sum(a.n_tokens for a in above)
        seen = [t for a in above for t in range(a.offset, a.offset + a.n_tokens)]
        assert [t for s in n.ancestors for t in range(s.start, s.stop)] == seen
        assert all(x.stop < y.start for x, y in zip(n.ancestors, n.ancestors[1:]))
        line.append(bytes(n.node))


def test_empty_table(spark):
    empty = frame(spark, chats()).where("false")
    tables = C.format_tree(empty, CHAT_RANKS, CHAT_SPLIT)
    assert [t.count() for t in tables] == [0, 0, 0]
    assert C.read_back(*tables, CHAT_RANKS, CHAT_SPLIT).count() == 0
