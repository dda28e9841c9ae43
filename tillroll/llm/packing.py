"""Best-fit packing of tokenised documents into sequences of fixed length.

Bounded-space online best fit: a task holds a fixed number of open sequences,
found through a bitset keyed by free space.  A piece goes to the fullest open
sequence that still has room; if none has, a new one opens, and where all places
are taken the fullest closes first.
"""

from __future__ import annotations

import json
import zlib
from functools import cached_property
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillroll.llm._shared import cut, map_arrow

LENGTH = 2048
OPEN = 16_384             # open sequences of a task
TASK_TOKENS = 1 << 26     # tokens packed by one task: what its last open sequences waste is under a thousandth
END_ID = 0

#: Texts with other characters, information separators or special strings go through the library whole.
USUAL = r"^[\x00-\x1b\x20-\x{12f}\x{131}-\x{239}\x{23b}-\x{23d}\x{23f}-\x{24f}]*$"
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\pL+|\pN|[^\x09-\x0D \x{85}\x{A0}\pL\pN]+"
WORD_END = "\x1f"
AT_ONCE = 1 << 24         # bytes of text whose words are looked up together


class WordTokens:
    """Ids of whole texts for a BPE vocabulary with word ends.

    The tokenizer lower-cases, drops white space, splits words from digits and
    signs, and merges within those parts only.  So for texts in plain Latin
    script a white-space-separated word always has the same ids: the distinct
    words of some megabytes of text are merged at once by tiktoken's byte-pair
    merger over the same vocabulary, with a separator that such texts don't
    have as the word end.  All other texts are encoded by the tokenizer itself."""

    def __init__(self, path: str):
        import tiktoken
        self.path = path
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of = {c: b for b, c in _byte_letters().items()}
        end, mark = model["end_of_word_suffix"], WORD_END.encode()

        def raw(piece: str) -> bytes:
            last = piece.endswith(end)
            return bytes(byte_of[c] for c in (piece[:-len(end)] if last else piece)) + mark * last

        # a last byte joins its word end before all else, then come the merges in their order
        ranks = {bytes([b]) + mark: b for b in range(256)}
        ranks |= {bytes([b]): 256 + b for b in range(256)}
        for merge in model["merges"]:
            ranks.setdefault(raw("".join(merge.split(" ") if isinstance(merge, str) else merge)), len(ranks))
        vocabulary = {raw(p): i for p, i in model["vocab"].items()}
        self.ids, self.ends = np.zeros(len(ranks), "<u4"), np.zeros(len(ranks), bool)
        for piece, rank in ranks.items():
            self.ids[rank], self.ends[rank] = vocabulary.get(piece, 0), piece.endswith(mark)
        self.merger = tiktoken.Encoding("words", pat_str=f"[^{WORD_END}]*{WORD_END}", mergeable_ranks=ranks,
                                        special_tokens={})

    @cached_property
    def library(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.path)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), without end tokens."""
        texts, sizes = pc.fill_null(texts, ""), pc.binary_length(texts).to_numpy(zero_copy_only=False)
        marks = np.cumsum(np.nan_to_num(sizes)) // AT_ONCE
        starts = [0, *(np.flatnonzero(np.diff(marks)) + 1).tolist(), len(texts)]
        for a, b in zip(starts, starts[1:]):
            yield from self._encode(texts.slice(a, b - a))

    def _encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        usual = pc.and_(pc.match_substring_regex(texts, USUAL), pc.invert(pc.match_substring(texts, "<|")))
        lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.if_else(usual, texts, "")))
        lists = pc.list_flatten(lists), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = pc.dictionary_encode(lists[0])
        marked = pc.replace_substring_regex(words.dictionary, PARTS, r"\0" + WORD_END)
        parts = np.cumsum(pc.count_substring(marked, WORD_END).to_numpy())
        ranks = self.merger.encode_to_numpy("".join(marked.to_pylist()))
        ids = self.ids[ranks]
        # where each distinct word's ids end, then the ids of all words in their order
        stops = np.append(0, np.flatnonzero(self.ends[ranks]) + 1)[parts]
        begins = np.append(0, stops[:-1]) if len(stops) else stops
        index = words.indices.to_numpy()
        length = (stops - begins)[index]
        ends = np.cumsum(length)
        flat = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[index] - (ends - length), length)]
        bounds = np.append(0, ends)[lists[1]]
        for i, ok in enumerate(usual.to_pylist()):
            yield (flat[bounds[i]:bounds[i + 1]] if ok else np.array(
                self.library.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4"))


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_TOKENS: dict[str, WordTokens] = {}


def _pieces(path: str, length: int, with_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _TOKENS.get(path) or _TOKENS.setdefault(path, WordTokens(path))
        end, step = np.array([END_ID], "<u4").tobytes(), 4 * length
        pa.set_cpu_count(1)           # a task has one core
        for b in batches:
            doc, piece, start, size, crc, ids = [], [], [], [], [], []
            for d, found in zip(b.column("doc_id").to_pylist(), tokens.encode(b.column("text"))):
                raw = found.tobytes() + end
                for k in range(0, len(raw), step):
                    part = raw[k:k + step]
                    doc.append(d)
                    piece.append(k // step)
                    start.append(k // 4)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(size, pa.int64()), pa.array(crc, pa.int64())]
                + [pa.array(ids, pa.binary())] * with_ids,
                ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
    return pieces


def tokenised_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id",
                     text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ``ids``, little-endian bytes)."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(narrow, _pieces(tokenizer, length, with_ids),
                     "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class OpenSequences:
    """The open sequences of a task, in a bitset keyed by free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most, self.open, self.made = length, most, 0, 0
        self.free = 0                                             # bit f: some open sequence has f places free
        self.at: list[list[int]] = [[] for _ in range(length + 1)]   # their numbers, by free space

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of a piece."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.most:                            # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.length, self.made
            self.made += 1
        left = space - size
        if left:
            self.at[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.length - space

    def _take(self, space: int) -> int:
        number = self.at[space].pop()
        if not self.at[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return number


def _pack(length: int, most: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences, first = OpenSequences(length, most), TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [sequences.place(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([first + n for n, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                [*b.schema.names, "sequence_id", "offset"])
    return pack


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, most_open: int = OPEN,
                   task_tokens: int = TASK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, [ids], sequence_id, offset.

    A document's ids end with id 0; only documents longer than ``length`` are
    cut.  A null or empty text is that id alone; repeated rows are packed each;
    a null id stays null; an empty table gives an empty result; other columns
    aren't read.

    The pieces (ids aside, some 40 bytes each) are stored; their total length
    says how many tasks pack them, about ``task_tokens`` each.  Pieces are dealt
    to the tasks by hash and packed from the longest to the shortest, an order
    that depends on the rows alone: a task that runs again places them alike."""
    pieces = cut(tokenised_pieces(docs, tokenizer, length, id_col, text_col, with_ids), "packing_pieces")
    total = pieces.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // task_tokens))
    dealt = (pieces.repartition(tasks, F.xxhash64("doc_id", "piece", "ids_crc32"))
             .sortWithinPartitions(F.desc("length"), "ids_crc32", "doc_id", "piece"))
    kind = StructType([*dealt.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return map_arrow(dealt, _pack(length, most_open), kind)
