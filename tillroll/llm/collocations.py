"""Phrase collocations: phrases of two to five words that occur together more often than their parts explain.

Counts are taken level by level: a phrase is counted only where both phrases
one word shorter are frequent, as every part of a frequent phrase is.  The
counts then form two streams, one in prefix order and one in suffix order
(words reversed).  In prefix order the parts that a phrase begins with lie on
the path above it and the phrases that extend it lie just below it, so one
walk along the sorted stream yields all left parts and the largest right
extension; the suffix stream yields right parts and left extensions.  Both
walks are merged phrase by phrase.  Nothing is looked up in a hash table.

A stream is dealt into ranges at sampled borders.  The at most five shorter
phrases that a border lies below are sent along to its range, so a first word
that many phrases share (or a language with most rows) spans many tasks.
"""

from __future__ import annotations

import bisect
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm._shared import cut, map_arrow

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
#: Bits of the map of frequent phrases: so many a phrase, up to a ceiling of 8 MB.  Beyond the
#: ceiling more infrequent phrases are counted (and dropped by their exact count), none is lost.
BITS_PER_PHRASE, MAX_MAP_BITS = 16, 26
#: Phrases a range of the sorted streams, and sampled phrases for each border.
RANGE_ROWS, SAMPLED = 100_000, 40

_BREAK = b"\xff"                                          # never part of UTF-8
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_STEP, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Bytes of texts whose phrases are counted together before anything leaves a task.
_TOGETHER = 32 << 20

COUNTS = "lang string, phrase string, f long"


def _hashes(words: pa.BinaryArray) -> np.ndarray:
    """A 64-bit hash of each of the (not empty) words."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    codes = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
    size, starts = np.diff(ends), ends[:-1] - ends[0]
    powers = np.full(int(size.max(initial=1)), _STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.add.reduceat(codes * powers[np.arange(len(codes)) - np.repeat(starts, size)], starts)
    return (sums ^ (sums >> np.uint64(31))) * _SPREAD


def _slots(sums: np.ndarray, lang: bytes, bits: int) -> np.ndarray:
    """Place in the map of each phrase, from the sum of its words' hashes (earlier words stepped further)."""
    return ((sums ^ np.uint64(xxhash.xxh64_intdigest(lang))) * _SPREAD) >> np.uint64(64 - bits)


def _sums(hashes: np.ndarray, size: int) -> np.ndarray:
    """Stepped sum of the ``size`` hashes from each position on."""
    out = hashes[:len(hashes) - size + 1].copy()
    for k in range(1, size):
        out = out * _STEP + hashes[k:len(hashes) - size + 1 + k]
    return out


def _words(texts: list[bytes]) -> tuple[np.ndarray, pa.BinaryArray, int]:
    """(word numbers in order, the distinct words, the number that stands for the end of a piece) of some texts."""
    data = _BREAK + (_BREAK + _BREAK.join(texts)).lower().translate(_PIECES).replace(_BREAK, b" \xff ")
    data = data.rstrip(b" \t")                            # so that no empty word comes out at the end
    text = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int32)), pa.py_buffer(data)])
    coded = pc.ascii_split_whitespace(text).flatten().dictionary_encode()     # splits at space and tab: no other is left
    return coded.indices.to_numpy(), coded.dictionary.view(pa.binary()), 0


def _phrases(lang: bytes, texts: list[bytes], size: int, seen: tuple[int, np.ndarray] | None):
    """(phrases, counts) of the texts' phrases of ``size`` words whose two parts one word shorter are in the map;
    for single words also the root, the empty phrase, with the number of words."""
    ids, names, stop = _words(texts)
    if size == 1:
        counts = np.bincount(ids, minlength=len(names))
        counts[stop] = 0
        some = np.flatnonzero(counts)
        return (pa.concat_arrays([pa.array([b""], pa.binary()), names.take(pa.array(some))]),
                np.concatenate([[counts.sum()], counts[some]]))
    bits, flags = seen
    short = flags[_slots(_sums(_hashes(names)[ids], size - 1), lang, bits)]
    borders = np.concatenate([[0], np.cumsum(ids == stop)])
    at = np.flatnonzero(short[:-1] & short[1:] & (borders[size:] == borders[:-size]))
    if not len(at):
        return pa.array([], pa.binary()), np.zeros(0, np.int64)
    key = ids[at].astype(np.int64)
    for k in range(1, size):                              # exact: pairs of (phrase so far, next word), renumbered
        _, first, key = np.unique(key * len(names) + ids[at + k], return_index=True, return_inverse=True)
    parts = [names.take(pa.array(ids[at[first] + k])) for k in range(size)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), np.bincount(key)


def _emit(size: int, seen, batches):
    seen = seen and (seen[0], np.unpackbits(seen[1].value, bitorder="little").view(bool))
    rows: dict[bytes, list[bytes]] = {}

    def counted():
        for lang, texts in rows.items():
            phrase, f = _phrases(lang, texts, size, seen)
            if len(phrase):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(phrase), pa.binary()).cast(pa.string()), phrase.cast(pa.string()),
                     pa.array(f, pa.int64())], ["lang", "phrase", "f"])
        rows.clear()

    held = 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            rows.setdefault(lang, []).append(text)
            held += len(text)
            if held >= _TOGETHER:
                yield from counted()
                held = 0
    yield from counted()


def _mark(bits: int, batches):
    """The words of the map that a batch of frequent phrases, all of one size, sets bits in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        phrases = batch.column(1).cast(pa.binary()).to_pylist()
        hashes = _hashes(pa.array(b" ".join(phrases).split(b" "), pa.binary())).reshape(len(phrases), -1)
        sums = hashes[:, 0].copy()
        for k in range(1, hashes.shape[1]):
            sums = sums * _STEP + hashes[:, k]
        langs, number = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        slots = np.zeros(len(sums), np.uint64)
        for i, lang in enumerate(langs):
            slots[number == i] = _slots(sums[number == i], lang.encode(), bits)
        yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)),
                                          pa.array((np.uint64(1) << (slots & np.uint64(63))).view(np.int64))], ["at", "mask"])


def _frequent_map(counts: DataFrame, total: int):
    """(bits, broadcast map of that many bits) of the counted phrases: at most 8 MB whatever their number."""
    bits = min(MAX_MAP_BITS, max(10, (BITS_PER_PHRASE * total).bit_length()))
    marks = map_arrow(counts.select("lang", "phrase"), partial(_mark, bits), "at long, mask long")
    found = marks.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[found.column("at").to_numpy()] = found.column("mask").to_numpy()
    return bits, counts.sparkSession.sparkContext.broadcast(words.view(np.uint8))


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                     min_count: int = MIN_COUNT) -> DataFrame:
    """All phrases of up to ``max_words`` words that occur at least ``min_count`` times, exactly counted.

    Returns lang, phrase (words joined by spaces), f; the empty phrase carries a
    language's number of words, even a small one.  Words are runs without space
    or tab, with A-Z lower-cased, of the pieces between ``.,;:!?`` and line
    ends; occurrences may overlap.  A null language is ``und``, a null text has
    no words, repeated rows count again, further columns are ignored, and an
    empty table gives an empty result."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).cast("binary").alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    levels, seen = [], None
    for size in range(1, max_words + 1):
        rows = map_arrow(texts, partial(_emit, size, seen), COUNTS)
        counts = rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
        counts = cut(counts.where((F.col("f") >= min_count) | (F.col("phrase") == "")), f"phrases_{size}")
        levels.append(counts)
        found = counts.where("phrase != ''")
        total = found.count()
        if not total:
            break
        if size < max_words:
            seen = _frequent_map(found, total)
    out = levels[0]
    for counts in levels[1:]:
        out = out.union(counts)
    return out


# --- the sorted streams --------------------------------------------------------------------------------------

def _split(phrase: str, backwards: bool) -> list[str]:
    words = phrase.split(" ") if phrase else []
    return words[::-1] if backwards else words


def _deal(borders: list, backwards: bool, batches):
    """Each phrase's range; phrases that a border extends also go to the border's range, as context."""
    above: dict[tuple, list[int]] = {}
    for part, (lang, words) in enumerate(borders, 1):
        for k in range(len(words)):
            above.setdefault((lang, words[:k]), []).append(part)
    for batch in batches:
        out = []
        for lang, phrase, f in zip(*(c.to_pylist() for c in batch.columns)):
            words = _split(phrase, backwards)
            own = bisect.bisect_right(borders, (lang, tuple(words)))
            out.append((own, True, lang, words, f))
            out.extend((p, False, lang, words, f) for p in above.get((lang, tuple(words)), ()) if p != own)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
                pa.int32(), pa.bool_(), pa.string(), pa.list_(pa.string()), pa.int64()))],
                ["part", "own", "lang", "words", "f"])


def _walk(backwards: bool, batches):
    """Along a sorted stream: each phrase with the counts on the path above it and its largest extension.

    The path holds at most ``max_words`` phrases and the root."""
    path: list[list] = []                                 # [part, own, lang, words, f, counts above, largest extension]
    out: list[tuple] = []

    def leave():
        part, own, lang, words, f, above, most = path.pop()
        out.append((lang, " ".join(words[::-1] if backwards else words), f if own else None,
                    above if own else None, most))

    def batch():
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
            pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.int64()))],
            ["lang", "phrase", "f", "above", "longer"])
        out.clear()
        return done

    for b in batches:
        for part, own, lang, words, f in zip(*(c.to_pylist() for c in b.columns)):
            while path and (path[-1][0] != part or path[-1][2] != lang or words[:len(path[-1][3])] != path[-1][3]):
                leave()
            if path:
                path[-1][6] = max(path[-1][6], f)
            path.append([part, own, lang, words, f, [p[4] for p in path], 0])
        if out:
            yield batch()
    while path:
        leave()
    if out:
        yield batch()


def _stream(phrases: DataFrame, backwards: bool, ranges: int, every: int) -> DataFrame:
    """One row a phrase: its count, the counts of its parts from the near end on, its largest extension at the far end."""
    sample = phrases.where((F.col("phrase") != "") & (F.pmod(F.xxhash64("lang", "phrase"), F.lit(every)) == 0))
    keys = sorted((r.lang, tuple(_split(r.phrase, backwards))) for r in sample.select("lang", "phrase").collect())
    borders = [keys[len(keys) * k // ranges] for k in range(1, ranges)] if len(keys) >= ranges else []
    dealt = map_arrow(phrases.select("lang", "phrase", "f"), partial(_deal, borders, backwards),
                      "part int, own boolean, lang string, words array<string>, f long")
    ordered = dealt.repartition(ranges, "part").sortWithinPartitions("part", "lang", "words")
    return map_arrow(ordered, partial(_walk, backwards),
                     "lang string, phrase string, f long, above array<long>, longer long")


def _score(percent: int, batches):
    """Each candidate's lowest-scoring cut, in exact integers; phrases that a longer one covers are left out."""
    for batch in batches:
        out = []
        for lang, phrase, a, left, right, longer in zip(*(c.to_pylist() for c in batch.columns)):
            if 100 * longer >= percent * a:
                continue
            n, size = left[0], len(left)                  # left: the root, then 1 .. size - 1 words
            score, k = min((1000 * a * n // (left[k] * right[size - k]), k) for k in range(1, size))
            out.append((lang, phrase, a, left[k], right[size - k], n, score))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out), [pa.string()] * 2 + [pa.int64()] * 5)], ["lang", "phrase", "a", "l", "r", "n", "score"])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, percent: int = 100) -> DataFrame:
    """The ``top`` phrases of each language by how far they exceed their parts' counts.

    A phrase of 2 to ``max_words`` words with count ``a >= min_count`` scores
    ``floor(1000 * a * n / (l * r))`` for its lowest-scoring cut (ties: the
    earliest), where n counts the language's words and l and r count the two
    parts.  Phrases inside a longer one with ``100 * f >= percent * a`` are left
    out.  Returns lang, rank, phrase, a, l, r, n, score; ties in rank go to the
    larger count, then the smaller phrase in byte order.  Nulls, empty texts,
    repeated rows, further columns and empty tables: see ``frequent_phrases``."""
    phrases = frequent_phrases(docs, text_col, lang_col, max_words, min_count)
    total = phrases.count()
    ranges = 1 + total // RANGE_ROWS
    every = max(1, total // (SAMPLED * ranges))
    forth, back = (_stream(phrases, backwards, ranges, every) for backwards in (False, True))
    both = (forth.select("lang", "phrase", "f", F.col("above").alias("left"), F.lit(None).cast("array<long>").alias("right"),
                         "longer")
            .union(back.select("lang", "phrase", "f", F.lit(None).cast("array<long>"), "above", "longer")))
    merged = both.groupBy("lang", "phrase").agg(*(F.max(c).alias(c) for c in ("f", "left", "right", "longer")))
    scored = map_arrow(merged.where(F.size("left") > 1), partial(_score, percent),
                       "lang string, phrase string, a long, l long, r long, n long, score long")
    return _ranked(scored, top)


def _ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
