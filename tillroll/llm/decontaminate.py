"""Benchmark decontamination with one Aho-Corasick automaton.

The windows of all benchmark items (ten consecutive words, or a whole shorter
item) become keys of one automaton over word symbols; every document's words
are translated to those symbols and scanned once.  Matches are mapped back to
word positions, and those to code points of the original text.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillroll.llm._shared import map_arrow
from tillroll.session import unique_name

WINDOW = 10
#: Lower-cases A-Z and turns every ASCII byte that is no word character into a space.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
             for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")   # the same words in the original text
MAX_KEYS = 2_000_000      # windows of one automaton; more are dealt to further automata


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


BASE = 64                 # a word is spelt in digits to this base, so a node has few children


class Windows:
    """The automaton and the word spellings of one set of windows.

    A word that no window has is spelt in NULs.  Each digit place has symbols
    of its own, so a match always starts at a word."""

    def __init__(self, windows: list[tuple[tuple[bytes, ...], list[str]]]):
        import ahocorasick
        vocabulary = sorted({w for words, _ in windows for w in words})
        self.places = 1
        while BASE ** self.places < len(vocabulary):
            self.places += 1
        self.spelling = {w: "".join(chr(1 + BASE * p + i // BASE ** p % BASE) for p in range(self.places))
                         for i, w in enumerate(vocabulary)}
        self.automaton = ahocorasick.Automaton()
        for words, items in windows:
            self.automaton.add_word("".join(map(self.spelling.__getitem__, words)), (len(words), items))
        if windows:
            self.automaton.make_automaton()
            # no match crosses a NUL, so only runs as long as the shortest key are scanned
            self.runs = re.compile("[^\0]{%d,}" % (self.places * min(len(words) for words, _ in windows)))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word spans (start, end) of all occurrences and the items they belong to."""
        spans, items = [], set()
        if self.spelling:
            get, other = self.spelling.get, "\0" * self.places
            line = "".join([get(w, other) for w in words])
            for run in self.runs.finditer(line):
                for last, (n, ids) in self.automaton.iter(line, *run.span()):
                    end = (last + 1) // self.places
                    spans.append((end - n, end))
                    items.update(ids)
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(words: array<binary>, items: array<string>): distinct windows and the items that have them (null ids aside)."""
    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, ids = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(t)
                if w:
                    wins = {tuple(w[k:k + WINDOW]) for k in range(max(1, len(w) - WINDOW + 1))}
                    keys += [list(x) for x in wins]
                    ids += [i] * len(wins)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.list_(pa.binary())), pa.array(ids, pa.string())],
                                             ["words", "item"])

    items = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return (map_arrow(items, cut_windows, "words array<binary>, item string")
            .groupBy("words").agg(F.collect_set("item").alias("items")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  max_keys: int = MAX_KEYS, keep_row: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted strings), n_items,
    items_sha256, spans (code points of the original text, merged), contaminated.

    Null and empty texts have no words and no hits; benchmark items without words
    have no window; words in a window of an item with a null id are hit, but name
    no item; items that share a window are all
    named; repeated rows give equal rows; an empty benchmark hits nothing; other
    columns aren't read (``keep_row`` carries the whole row as the struct ``row``).

    The windows are counted before they are collected: a set of more than
    ``max_keys`` is dealt to several automata by hash, and the rows pass through
    one scan after the other without a shuffle."""
    spark = docs.sparkSession
    wins = benchmark_windows(benchmark)
    n_keys = wins.count()
    shards = max(1, -(-n_keys // max_keys))
    if keep_row:
        out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    else:
        out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = StructType(out.schema.fields)
    more = StructType.fromDDL("n_words long, n_hit long, items array<string>, n_items long, items_sha256 string, "
                              "spans array<struct<start: int, end: int>>, contaminated boolean")
    hits = StructType.fromDDL("hits array<struct<a: int, b: int>>, items array<string>")
    done = StructType([f for f in first.fields if f.name != "text"] + more.fields)
    for shard in range(shards):
        part = wins.where(F.pmod(F.hash("words"), F.lit(shards)) == shard)
        keys = [(tuple(bytes(w) for w in r.words), sorted(r["items"])) for r in part.collect()]
        scan = _scanner(spark.sparkContext.broadcast(keys), unique_name("windows"), text_col if keep_row else None,
                        shard == shards - 1)
        out = map_arrow(out, scan, done if shard == shards - 1 else StructType(first.fields + hits.fields))
    return out


_BUILT: dict = {}


def _scanner(keys, name: str, in_row: str | None, last: bool):
    """One scan: adds its hits to those of earlier scans; the last one writes the result."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _BUILT:            # one automaton per worker, not per task
            _BUILT.clear()
            _BUILT[name] = Windows(keys.value)
        windows = _BUILT[name]
        for b in batches:
            column = b.column("row").field(in_row).cast(pa.string()) if in_row else b.column("text")
            texts, hits, items = column.to_pylist(), [], []
            n = b.num_rows
            before = (zip(b.column("hits").to_pylist(), b.column("items").to_pylist()) if "hits" in b.schema.names
                      else [([], [])] * n)
            n_words = []
            for t, (h, i) in zip(texts, before):
                words = words_of(t)
                spans, ids = windows.scan(words)
                hits.append(merged(spans + [(s["a"], s["b"]) for s in h]))
                items.append(sorted(ids.union(i)))
                n_words.append(len(words))
            kept = [c for c in b.schema.names if c == "row" or c == "doc_id" or c == "text" and not last]
            made = _result(texts, n_words, hits, items) if last else {
                "hits": pa.array([[{"a": x, "b": y} for x, y in h] for h in hits],
                                 pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + list(made.values()), kept + list(made))
    return scan


def _result(texts: list, n_words: list[int], hits: list, items: list) -> dict[str, pa.Array]:
    n_hit = [sum(b - a for a, b in h) for h in hits]
    spans = []
    for t, h in zip(texts, hits):
        at = [m.span() for m in WORD.finditer(t)] if h else []
        spans.append([{"start": at[a][0], "end": at[b - 1][1]} for a, b in h])
    return {
        "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        "items": pa.array(items, pa.list_(pa.string())), "n_items": pa.array([len(x) for x in items], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
        "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_())}


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window, all columns as they were.

    Null and empty texts stay, repeated rows are judged each, clashing names
    don't matter, an empty table stays empty (see ``decontaminate``)."""
    return decontaminate(docs, benchmark, keep_row=True, **options).where("not contaminated").select("row.*")
