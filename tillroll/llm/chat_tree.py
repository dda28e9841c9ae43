"""Chat formatting as a prefix tree.

Conversations that share their first turns share those turns' nodes.  Nodes are
written depth first into one token stream, each once: a node's tokens stand
behind its first parent's, position ids go on from its ancestors' (as if the
conversation stood alone), and its attention reaches the stream intervals of its
ancestors and itself.

The template marks turns with control strings; inside texts those strings are
escaped, so the formatted text can be read back exactly.  A node's header, text
and footer are tokenised apart, so that shared nodes have the same tokens
everywhere and the loss mask (assistant texts) falls on token borders.

Depth-first order needs no walk: it is the order of the conversations' paths
(lists of node digests), and a node belongs to the first path that has it.
Offsets are a two-level prefix sum over that order, so a tree may hold any share
of the conversations.
"""

from __future__ import annotations

import base64
import hashlib
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm._shared import cut, map_arrow

OPEN, CLOSE, ASSISTANT = "###", "</turn>", "assistant"
ESCAPES = {"\\": "\\\\", OPEN: "\\h", CLOSE: "\\e", ":": "\\c"}
ESCAPED = {v: k for k, v in ESCAPES.items()}
IN_TEXT = re.compile(r"\\|###|</turn>")
IN_ROLE = re.compile(r"\\|###|</turn>|:")
OUT = re.compile(r"\\[\\hec]")
TURN = re.compile(r"### ([^:]*): (.*?)</turn>\n", re.S)


def escape(text: str, what: re.Pattern = IN_TEXT) -> str:
    return what.sub(lambda m: ESCAPES[m.group()], text)


def unescape(text: str) -> str:
    return OUT.sub(lambda m: ESCAPED[m.group()], text)


def segments(role: str, text: str) -> tuple[str, str, str]:
    """Header, text and footer of a formatted turn."""
    return f"{OPEN} {escape(role, IN_ROLE)}: ", escape(text), f"{CLOSE}\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


_CODERS: dict = {}


def coder(ranks: str, pattern: str):
    import tiktoken
    if (ranks, pattern) not in _CODERS:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _CODERS[ranks, pattern] = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _CODERS[ranks, pattern]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn -> the node of each turn: a digest of all turns so far."""
    conv, digest, depth = object(), b"", 0
    for b in batches:
        nodes, parents, depths = [], [], []
        for c, r, t in zip(*(b.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
            if c != conv:
                conv, digest, depth = c, b"", 0
            role, text = r.encode("utf-8", "surrogatepass"), t.encode("utf-8", "surrogatepass")
            parents.append(digest)
            digest = hashlib.sha256(digest + len(role).to_bytes(8, "big") + role + text).digest()[:16]
            nodes.append(digest)
            depths.append(depth)
            depth += 1
        yield pa.RecordBatch.from_arrays(
            [b.column("conv_id"), pa.array(depths, pa.int32()), pa.array(nodes, pa.binary()),
             pa.array(parents, pa.binary()), b.column("role"), b.column("text")],
            ["conv_id", "depth", "node", "parent", "role", "text"])


def _tokens(ranks: str, pattern: str):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(ranks, pattern).encode_ordinary
        for b in batches:
            ids, start, stop = [], [], []
            for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist()):
                head, body, foot = map(encode, segments(r, t))
                ids.append(head + body + foot)
                start.append(len(head))
                stop.append(len(head) + (len(body) if r == ASSISTANT else 0))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("parent"), b.column("depth"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())],
                ["node", "parent", "depth", "ids", "n_tokens", "loss_start", "loss_stop"])
    return tokens


def _ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        rank = pa.array((part << 40) + np.arange(at, at + b.num_rows, dtype=np.int64))
        at += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([part] * b.num_rows, pa.int32()), rank, *b.columns],
                                         ["part", "rank", *b.schema.names])


def _attend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths' nodes in order -> position and ancestor intervals of the nodes that the path owns."""
    path, position, spans = None, 0, []
    for b in batches:
        out: tuple[list, list, list] = ([], [], [])
        for rank, owner, node, offset, n in zip(*(b.column(k).to_pylist() for k in (
                "rank", "owner", "node", "offset", "n_tokens"))):
            if rank != path:
                path, position, spans = rank, 0, []
            if owner == rank:
                out[0].append(node)
                out[1].append(position)
                out[2].append([{"start": x, "stop": y} for x, y in spans])
            position += n
            if spans and spans[-1][1] == offset:
                spans[-1] = (spans[-1][0], offset + n)
            else:
                spans = [*spans, (offset, offset + n)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            ["node", "position", "ancestors"])


def format_tree(conversations: DataFrame, ranks: str, pattern: str, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The prefix tree of all conversations as three stored tables.

    * nodes: node, parent (empty for a first turn), depth, ids, n_tokens, offset
      (place in the stream, depth first, gapless), position (position id of the
      first token), ancestors (stream intervals before the node that it attends
      to, with neighbours joined), loss_start and loss_stop (token range under
      the loss mask; empty unless the role is assistant);
    * paths: leaf, depth, node - the turns of each distinct conversation;
    * members: conv_id, leaf.

    Turns go by ``turn``, then role and text (so repeated turns have an order);
    a null text or role is empty; rows with a null conversation id are one
    conversation; an empty table gives empty tables; other columns aren't read.
    A conversation's texts are streamed through one task in sorted order, never
    held together; its digests (16 bytes a turn) are."""
    spark = conversations.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blank = F.lit("")
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), blank).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), blank).alias("text"))
    rows = rows.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    turns = cut(map_arrow(rows.select("conv_id", "role", "text"), _chain,
                          "conv_id long, depth int, node binary, parent binary, role string, text string"), "chat_turns")
    own = turns.dropDuplicates(["node"]).select("node", "parent", "depth", "role", "text")
    nodes = cut(map_arrow(own, _tokens(ranks, pattern), "node binary, parent binary, depth int, ids array<int>, "
                          "n_tokens long, loss_start int, loss_stop int"), "chat_nodes")
    # each distinct conversation's path, in depth-first order
    whole = turns.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("depth", "node"))), lambda x: x["node"]).alias("path"))
    whole = cut(whole.select("conv_id", F.element_at("path", -1).alias("leaf"), "path"), "chat_paths")
    first = whole.groupBy("leaf").agg(F.min_by("path", F.coalesce("conv_id", F.lit(-1))).alias("path"))
    ordered = first.select("path", "leaf").repartitionByRange(tasks, "path").sortWithinPartitions("path")
    ordered = cut(map_arrow(ordered, _ranked, "part int, rank long, path array<binary>, leaf binary"), "chat_order")
    steps = ordered.select("part", "rank", "leaf", F.posexplode("path").alias("depth", "node"))
    # a node belongs to the first path that has it; offsets follow (path, depth)
    owned = steps.groupBy("node").agg(F.min("rank").alias("owner")).join(nodes.select("node", "depth", "n_tokens"), "node")
    owned = owned.withColumn("part", F.shiftright("owner", 40))
    before = Window.partitionBy("part").orderBy("owner", "depth").rowsBetween(Window.unboundedPreceding, -1)
    owned = cut(owned.withColumn("inside", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "chat_owned")
    base, at = [], 0                                         # one row per task of the order
    for r in owned.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        base.append((r.part, at))
        at += r.n
    bases = spark.createDataFrame(base, "part long, base long")
    placed = cut(owned.join(F.broadcast(bases), "part").select(
        "node", "owner", "n_tokens", (F.col("base") + F.col("inside")).alias("offset")), "chat_placed")
    walk = (steps.select("rank", "depth", "node").join(placed, "node").repartition(tasks, "rank")
            .sortWithinPartitions("rank", "depth").select("rank", "owner", "node", "offset", "n_tokens"))
    seen = map_arrow(walk, _attend, "node binary, position long, ancestors array<struct<start: bigint, stop: bigint>>")
    full = nodes.join(placed.select("node", "offset"), "node").join(seen, "node")
    return cut(full, "chat_tree"), steps.select("leaf", "depth", "node"), whole.select("conv_id", "leaf")


def read_back(nodes: DataFrame, paths: DataFrame, members: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens.

    Tokens of each distinct conversation's nodes are decoded, parsed by the
    template and unescaped; conversations with the same path share that work."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (paths.join(nodes.select("node", "ids", "loss_start", "loss_stop"), "node").repartition(tasks, "leaf")
            .sortWithinPartitions("leaf", "depth").select("leaf", "ids", "loss_start", "loss_stop"))
    read = map_arrow(rows, _read(ranks, pattern), "leaf binary, n_turns long, turns_sha256 string, loss_chars long, "
                     "loss_sha256 string, formatted_chars long, n_tokens long")
    return members.join(cut(read, "chat_read"), "leaf").drop("leaf")


def _read(ranks: str, pattern: str):
    kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = coder(ranks, pattern).decode_bytes
        leaf, done = None, []

        def close():
            done.append((leaf, n[0], turns.hexdigest(), n[1], loss.hexdigest(), n[2], n[3]))

        for b in batches:
            for x, ids, start, stop in zip(*(b.column(k).to_pylist() for k in (
                    "leaf", "ids", "loss_start", "loss_stop"))):
                if x != leaf:
                    if leaf is not None:
                        close()
                    leaf, n, turns, loss = x, [0, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                formatted = decode(ids).decode()
                for role, text in parse(formatted):
                    turns.update(f"{role}\n{text}\n".encode())
                    n[0] += 1
                learnt = unescape(decode(ids[start:stop]).decode())
                loss.update(learnt.encode())
                n[1] += len(learnt)
                n[2] += len(formatted)
                n[3] += len(ids)
            if len(done) > 1000:
                yield _rows(done, kinds, names)
                done = []
        if leaf is not None:
            close()
        yield _rows(done, kinds, names)
    return read


def _rows(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)
