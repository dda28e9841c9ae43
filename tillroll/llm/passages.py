"""Passages that documents share, from sampled places, each extended to the whole shared run.

Every 28 neighbouring words have a sampled place: where the smallest hash of a
five-word shingle is.  Documents that share 51 words or more share at least one
place with the 24 words behind it.  One row a place is compared, not one a word:

1. Places whose 24 words stand in several documents are found by an aggregate.
2. In a document, neighbouring shared places form a chain while the words from
   one to the end of the next (a segment) are shared too, by an aggregate again.
3. Only the two ends of a chain are looked at more closely: how many of the up to
   27 words before the first place, or behind the last one's 24, another document
   shares.  Digests of every fifth number of words are compared with all documents
   that have the place; the first one that shares the most is then compared word
   by word.

Every piece of a chain (segment or end) knows the first document that has all
of it.  Nothing is lost where pieces overlap: a document keeps the pieces that it
is the first to have, whatever else repeats there.
"""

from __future__ import annotations

from functools import partial
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm._shared import cut, map_arrow

SHINGLE, WINDOW, SAMPLE = 5, 24, 28
PASSAGE = WINDOW + SAMPLE - 1      # 51 words: the shortest run that surely has a place
REACH = SAMPLE - 1                 # words beyond an end that may belong to the run
STEP = 5                           # first the ends are compared at every fifth word
LEVELS = REACH // STEP
ROUGH, FINE = STEP * np.arange(1, LEVELS + 1), np.arange(STEP)
AT_ONCE = 1 << 20                  # code points of text that are hashed together
#: Bits of a map of wanted digests: so many each, up to 8 MB.  A full map lets more rows through to an exact join.
BITS_EACH, MAX_BITS = 16, 26

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_M1_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACES = np.array([chr(c).isspace() for c in range(0x3002)])     # no white space is beyond

#: Who comes first: the smallest id, null ids last, then the row's digest.
RANK = "struct(doc_id is null as unnamed, doc_id, row)"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M2
    return x ^ (x >> np.uint64(29))


class Text:
    """Some texts as one array of code points: where their lower-cased words and their lines are, and the words' hashes."""

    def __init__(self, texts: list[str | None]):
        texts = [t or "" for t in texts]
        lower = [t.lower() for t in texts]
        joined = "\n".join(lower)
        codes = _codes(joined)
        sizes = np.array([len(t) for t in lower], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1                              # of each text
        begin, end = _word_bounds(codes)
        self.word = _word_hashes(joined, codes, begin, end)
        self.lengths = np.diff(np.append(np.searchsorted(begin, starts), len(begin)))
        stop = np.append(np.flatnonzero(codes == 10), len(codes))              # of each line; texts end lines, too
        start = np.append(0, stop[:-1] + 1)
        self.line_words = np.diff(np.append(np.searchsorted(begin, start), len(begin)))
        self.line_text = np.searchsorted(starts, start, "right") - 1
        shift = np.repeat(starts, self.lengths)
        self.begin, self.end = begin - shift, end - shift
        self.line_start, self.line_stop = start - starts[self.line_text], stop - starts[self.line_text]
        for i, t in enumerate(texts):
            if len(t) != sizes[i]:                                             # lower case is longer: places of the text itself
                self._places_in(i, _codes(t))

    def _places_in(self, i: int, codes: np.ndarray) -> None:
        words = slice(int(self.lengths[:i].sum()), int(self.lengths[:i + 1].sum()))
        self.begin[words], self.end[words] = _word_bounds(codes)
        lines = self.line_text == i
        self.line_stop[lines] = np.append(np.flatnonzero(codes == 10), len(codes))
        self.line_start[lines] = np.append(0, self.line_stop[lines][:-1] + 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _word_bounds(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(codes) + 2, bool)
    np.logical_not(_SPACES[np.minimum(codes, 0x3001)], out=inside[1:-1])
    turn = np.flatnonzero(inside[1:] != inside[:-1])
    return turn[::2], turn[1::2]


def _word_hashes(text: str, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``pandas.util.hash_array`` of the words, each different word hashed once: a sum over its code points tells them apart."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes * M1) * _powers(M1, len(codes)), out=sums[1:])
    keys = (sums[end] - sums[begin]) * _powers(_M1_INVERSE, len(codes))[begin]
    number, different = pd.factorize(mix(keys + (end - begin).astype(np.uint64) * M2))
    at = np.zeros(len(different), np.int64)
    at[number[::-1]] = np.arange(len(number))[::-1]                            # where each stands first
    words = np.array([text[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())], dtype=object)
    return pd.util.hash_array(words, categorize=False)[number]


_KEPT: dict[int, np.ndarray] = {}


def _powers(x: np.uint64, n: int) -> np.ndarray:
    """x to the power of 0, 1, .. n - 1; kept for the texts that are hashed together."""
    if len(_KEPT.get(int(x), ())) < n:
        out = np.full(max(n, AT_ONCE), x)
        out[0] = 1
        _KEPT[int(x)] = np.multiply.accumulate(out)
    return _KEPT[int(x)][:n]


class Stream:
    """The words of some texts, hashed: digests of any run of words, sampled places, code points."""

    def __init__(self, texts: list[str | None], *split):
        """``split``: the words and their numbers, which callers may know already, aren't needed."""
        self.parts = Text(texts)
        self.lengths = self.parts.lengths
        self.first = np.cumsum(self.lengths) - self.lengths                    # of each text's words
        self.word = self.parts.word
        n = max(0, len(self.word) - SHINGLE + 1)
        hashes = np.zeros(n, np.uint64)
        for j in range(SHINGLE):
            hashes = hashes * M1 + self.word[j:j + n]
        self.shingle, self.text = mix(hashes), np.repeat(np.arange(len(self.lengths)), self.lengths)
        self._down = _powers(_M1_INVERSE, len(self.word) + 1)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.word * _powers(M1, len(self.word)))])

    def digest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A digest of the words from ``begin`` up to ``end`` (places in all texts together)."""
        return mix((self._sums[end] - self._sums[begin]) * self._down[begin] + (end - begin).astype(np.uint64) * M2)

    def places(self) -> np.ndarray:
        """Sampled places that have 24 words of their text behind them, in order."""
        own = np.flatnonzero(self.text[:len(self.shingle)] == self.text[SHINGLE - 1:])   # shingles within a text
        if len(own) < SAMPLE:
            return np.zeros(0, np.int64)
        rank, at = self.shingle[own], own - self.first[self.text[own]]
        low = np.uint64((1 << 20) - 1)
        rank = (rank & ~low) | (at.astype(np.uint64) & low)
        smallest, width = rank, 1
        while 2 * width <= SAMPLE:
            smallest = np.minimum(smallest[:-width], smallest[width:])
            width *= 2
        n = len(own) - SAMPLE + 1
        smallest = np.minimum(smallest[:n], smallest[SAMPLE - width:SAMPLE - width + n])
        text = self.text[own]
        fits = at + WINDOW <= self.lengths[text]
        start = np.flatnonzero((text[:n] == text[SAMPLE - 1:]) & fits[SAMPLE - 1:])
        # where each window's smallest is: its low bits are the place in the text
        place = (smallest[start] & low).astype(np.int64) + (at[start] >> 20 << 20)
        place = np.where(place < at[start], place + (1 << 20), place)
        return np.unique(self.first[text[start]] + place)

    def code_points(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each word begins and ends in its text."""
        return self.parts.begin, self.parts.end


def blocks(*columns: list) -> Iterator[tuple[list, ...]]:
    """The columns in blocks of about a million code points of the last one."""
    at, texts = 0, columns[-1]
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and size < AT_ONCE:
            size += len(texts[to] or "")
            to += 1
        yield tuple(c[at:to] for c in columns)
        at = to


def streams(batch: pa.RecordBatch, keep=None) -> Iterator[tuple[list, list, Stream]]:
    """(rows, ids, stream) of a batch (row, doc_id, text), in blocks; with ``keep`` only of some rows."""
    row, ids, texts = (batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))
    if keep is not None:
        some = keep(batch.column("row").to_numpy().view(np.uint64)).tolist()
        row, ids, texts = ([c[i] for i in some] for c in (row, ids, texts))
    for r, d, t in blocks(row, ids, texts):
        yield r, d, Stream(t)


# --- maps of wanted digests ----------------------------------------------------------------------------------

def wanted(df: DataFrame, name: str) -> tuple[int, object]:
    """(bits, broadcast map) of a column of digests: sized by the number of rows, at most 8 MB."""
    bits = min(MAX_BITS, max(10, (BITS_EACH * df.count()).bit_length()))
    slot = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    found = (df.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("mask")).toArrow())
    table = np.zeros(1 << (bits - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return bits, df.sparkSession.sparkContext.broadcast(table.tobytes())


def on_map(map_of: tuple[int, object], digests: np.ndarray) -> np.ndarray:
    """Which digests may be wanted: none that is wanted is missing."""
    bits, table = map_of[0], np.frombuffer(map_of[1].value, np.uint64)
    slot = digests & np.uint64((1 << bits) - 1)
    return np.flatnonzero((table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))


def some_of(map_of: tuple[int, object], name: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose column ``name`` may be wanted."""
    for b in batches:
        yield b.take(pa.array(on_map(map_of, b.column(name).to_numpy().view(np.uint64))))


# --- scans ---------------------------------------------------------------------------------------------------

def place_digests(s: Stream, at: np.ndarray) -> np.ndarray:
    return s.digest(at, at + WINDOW)


def _shared_places(map_of, batches):
    """Places whose 24 words may be shared: number in the text, code points, digest, digest of the segment to the next."""
    for batch in batches:
        for rows, ids, s in streams(batch):
            at = s.places()
            one = place_digests(s, at)
            hit = on_map(map_of, one)
            text = s.text[at]
            follows = np.concatenate([text[1:] == text[:-1], [False]]) if len(at) else np.zeros(0, bool)
            segment = s.digest(at, np.where(follows, np.roll(at, -1) + WINDOW, at + WINDOW))
            begin, end = s.code_points()
            numbers = (np.arange(len(at)) - np.searchsorted(text, text)).astype(np.int32)
            t = text[hit].tolist()
            rough = [_around(s, at[hit], side, ROUGH)[0] for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[i] for i in t], pa.int64()), pa.array([ids[i] for i in t], pa.int64()),
                 pa.array(numbers[hit]), pa.array(begin[at[hit]].astype(np.int32)),
                 pa.array(end[at[hit] + WINDOW - 1].astype(np.int32)), pa.array(one[hit].view(np.int64)),
                 pa.array(np.where(follows, segment, 0)[hit].view(np.int64), mask=~follows[hit]),
                 pa.array((at[hit] - s.first[text[hit]]).astype(np.int32)), *rough],
                ["row", "doc_id", "number", "start", "stop", "one", "segment", "word", "left", "right"])


def _around(s: Stream, at: np.ndarray, side: int, steps: np.ndarray) -> tuple[pa.ListArray, np.ndarray, np.ndarray, pa.Array]:
    """Digests (32 bits) of so many words before (side 0) or behind (side 1) places, as far as the text goes;
    which of them there are, where they end, and the lists' offsets.  ``steps``: of all places, or a row for each."""
    text = s.text[at]
    room = at - s.first[text] if side == 0 else s.first[text] + s.lengths[text] - at - WINDOW
    near = steps <= room[:, None]
    if side == 0:
        far = np.where(near, at[:, None] - steps, at[:, None])
        digests = s.digest(far, np.broadcast_to(at[:, None], far.shape))
    else:
        far = np.where(near, at[:, None] + WINDOW + steps, at[:, None] + WINDOW)
        digests = s.digest(np.broadcast_to(at[:, None] + WINDOW, far.shape), far)
    offsets = pa.array(np.concatenate([[0], np.cumsum(near.sum(axis=1))]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(digests[near].astype(np.uint32).view(np.int32))), near, far, offsets


def key(row: np.ndarray, other: np.ndarray, kind: np.ndarray | int) -> np.ndarray:
    return mix((row.view(np.uint64) * M1) ^ (other.astype(np.int64).view(np.uint64) * M2) ^ np.asarray(kind).astype(np.uint64))


def _kind(side, level):
    """Of the key of a place's side that is asked at a level; the side alone is the kind of its key at any level."""
    return 2 + side + 2 * level


def _keys(batches):
    """Rows (side, level, row, other) as digests: of the side at any level, and at this one."""
    for batch in batches:
        side, level, row, other = (c.to_numpy().astype(np.int64) for c in batch.columns)
        keys = np.concatenate([key(row, other, side), key(row, other, _kind(side, level))])
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def _ends(row_map, place_map, partner_map, batches):
    """Of the asked places and their partners, at each level asked for, the digests of the words shared for sure and of
    1, 2, .. more beyond, and the code points they reach."""
    for batch in batches:
        for rows, ids, s in streams(batch, lambda r: on_map(row_map, r)):
            at = s.places()
            text = s.text[at]
            one = place_digests(s, at).view(np.int64)
            begin, end = s.code_points()
            numbers = np.arange(len(at)) - np.searchsorted(text, text)
            row = np.array(rows, np.int64)[text]
            asked = (place_map, numbers), (partner_map, one)
            for side in (0, 1):
                found = []
                for map_of, other in asked:
                    near = on_map(map_of, key(row, other, side))
                    found += [near[on_map(map_of, key(row[near], other[near], _kind(side, level)))] + level * len(at)
                              for level in range(LEVELS + 1)]
                level, hit = np.divmod(np.unique(np.concatenate(found)), max(1, len(at)))
                p = at[hit]
                digests, near, far, offsets = _around(s, p, side, STEP * level[:, None] + FINE)
                reach = (begin[far] if side == 0 else end[far - 1])[near].astype(np.int32)
                t = pa.array(text[hit])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), side, np.int8)), pa.array(level.astype(np.int8)), pa.array(one[hit]),
                     pa.array(row[hit]), pa.array(ids, pa.int64()).take(t), pa.array(numbers[hit].astype(np.int32)), digests,
                     pa.ListArray.from_arrays(offsets, pa.array(reach)),
                     pa.array(begin[p].astype(np.int32)), pa.array(end[p + WINDOW - 1].astype(np.int32))],
                    ["side", "level", "one", "row", "doc_id", "number", "digests", "reach", "start", "stop"])


# --- the join of the pieces ----------------------------------------------------------------------------------

def _several(df: DataFrame, *keys: str) -> DataFrame:
    """The keys that stand in several documents, with the first and the last of them."""
    return (df.groupBy(*keys).agg(F.expr(f"min({RANK})").alias("first"), F.expr(f"max({RANK})").alias("last"))
            .where("first.row != last.row"))


def _partners(near: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` (side, row, number, one, ..) with ``first``, the first document that shares the most words beyond the
    place in steps of five (the place's first document if none shares five), ``level``, how many steps they share, and
    ``partner``, another document that does.

    Equal ends are one context, however many documents have it."""
    sides = cut(asked.select("side", "one").distinct(), "passage_sides")
    both = near.select(F.lit(0).cast("byte").alias("side"), "one", "row", "doc_id", F.col("left").alias("digests")).union(
        near.select(F.lit(1).cast("byte"), "one", "row", "doc_id", "right"))
    contexts = (both.join(sides, ["side", "one"], "left_semi").groupBy("side", "one", F.xxhash64("digests").alias("context"))
                .agg(F.first("digests").alias("digests"), F.expr(f"min({RANK})").alias("first"),
                     F.expr(f"max({RANK})").alias("last")))
    contexts = cut(contexts, "passage_contexts")
    place = contexts.groupBy("side", "one").agg(F.struct(F.min("first").alias("first"), F.max("last").alias("last")).alias("place"))
    tried = contexts.select("side", "one", "context", "first", "last", F.posexplode("digests").alias("n", "digest"))
    shared = tried.groupBy("side", "one", "n", "digest").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    shared = cut(shared.where("first.row != last.row"), "passage_levels")
    best = (tried.drop("first", "last").join(shared, ["side", "one", "n", "digest"])
            .groupBy("side", "one", "context").agg(F.max_by(F.struct("first", "last"), "n").alias("best"),
                                                   (F.max("n") + 1).cast("byte").alias("level")))
    found = asked.withColumn("context", F.xxhash64("digests")).join(cut(best, "passage_best"), ["side", "one", "context"], "left")
    found = found.join(place, ["side", "one"]).withColumn("with", F.coalesce("best", "place"))
    return found.select("side", "row", "chain", "number", "one", "start", "stop", "doc_id",
                        F.coalesce("level", F.lit(0).cast("byte")).alias("level"), F.col("with.first").alias("first"),
                        F.when(F.col("with.first.row") != F.col("row"), F.col("with.first")).otherwise(F.col("with.last")).alias(
                            "partner"))


def shared_passages(docs: DataFrame, places: DataFrame, least: int = PASSAGE) -> DataFrame:
    """Pieces (row, doc_id, start, stop, class_id, first) of the shared runs of at least ``least`` words.

    ``docs`` has row, doc_id, text; ``places`` (row, doc_id, one) the digests of
    its sampled places.  A run's words are shared in overlapping pieces of at
    least 24 words, mostly with one and the same document.  Beyond an end it
    reaches as far as the first document that shares the most words there, in
    steps of five; where several share different stretches, up to four words more
    may be shared with another."""
    classes = places.groupBy("one").agg(F.min("row").alias("lo"), F.max("row").alias("hi")).where("lo != hi").select("one")
    classes = cut(classes, "passage_classes")
    near = map_arrow(docs, partial(_shared_places, wanted(classes, "one")),
                     "row long, doc_id long, number int, start int, stop int, one long, segment long, word int, "
                     "left array<int>, right array<int>")
    near = cut(near.join(classes, "one", "left_semi"), "passage_places")
    segments = _several(near.where("segment is not null"), "segment").select("segment", F.col("first").alias("segment_first"))
    near = near.join(cut(segments, "passage_segments"), "segment", "left")
    # chains: neighbouring places in a document whose segment is shared; repeated rows fall away here
    by_place = Window.partitionBy("row").orderBy("number")
    near = near.withColumn("before", F.lag("number").over(by_place)).where("before is null or before != number")
    linked = (F.col("before") == F.col("number") - 1) & F.lag("segment_first").over(by_place).isNotNull()
    near = near.withColumn("opens", F.when(linked, 0).otherwise(1))
    near = near.withColumn("chain", F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    # the next place of the chain, for the segments' ends
    near = near.withColumn("next_stop", F.when(F.lead("opens").over(by_place) == 0, F.lead("stop").over(by_place)))
    near = cut(near.select("row", "doc_id", "chain", "number", "start", "stop", "word", "one", "segment",
                           "segment_first", "next_stop", "left", "right"), "passage_chains")
    end = F.struct("number", "one", "start", "stop", "left", "right")
    chains = cut(near.groupBy("row", "doc_id", "chain").agg(
        F.min_by(end, "number").alias("a"), F.max_by(end, "number").alias("b"),
        (F.max("word") - F.min("word") + WINDOW).alias("words")), "passage_ends")
    # both ends, compared with the documents that have the place
    asked = [chains.select("row", "doc_id", "chain", F.lit(side).cast("byte").alias("side"), f"{e}.number", f"{e}.one",
                           f"{e}.start", f"{e}.stop", F.col(f"{e}.{part}").alias("digests"))
             for side, e, part in ((0, "a", "left"), (1, "b", "right"))]
    asked = cut(_partners(near, asked[0].union(asked[1])), "passage_asked")
    who = asked.select("side", "level", "row", F.col("number").cast("long").alias("other")), asked.select(
        "side", "level", F.col("partner.row").alias("row"), F.col("one").alias("other"))
    maps = [wanted(cut(map_arrow(w, _keys, "key long").distinct(), "passage_keys"), "key") for w in who]
    rows = cut(who[0].select("row").union(who[1].select("row")).distinct(), "passage_rows")
    ends = map_arrow(docs, partial(_ends, wanted(rows, "row"), *maps),
                     "side byte, level byte, one long, row long, doc_id long, number int, digests array<int>, "
                     "reach array<int>, start int, stop int")
    ends = cut(ends.dropDuplicates(["side", "level", "row", "number"]), "passage_beyond")
    # word by word from the shared steps on; a partner that has the place several times is taken where it shares most
    here = ends.select("side", "level", "row", "number", F.col("digests").alias("x"), F.col("reach").alias("my_reach"))
    there = ends.select("side", "level", "one", F.col("row").alias("their_row"), F.col("doc_id").alias("their_id"), F.col("digests").alias("y"),
                        F.col("reach").alias("their_reach"), F.col("start").alias("their_start"), F.col("stop").alias("their_stop"))
    pairs = (asked.join(here, ["side", "level", "row", "number"]).withColumn("their_row", F.col("partner.row"))
             .join(there, ["side", "level", "one", "their_row"]))
    more = F.size(F.filter(F.zip_with("x", "y", lambda a, b: a == b), lambda same: same)) - 1    # 0: the steps alone
    pairs = pairs.withColumn("more", more).where("more >= 0").withColumn("n", STEP * F.col("level") + F.col("more")).drop("x", "y")
    rest = [c for c in pairs.columns if c not in ("side", "row", "number")]
    pairs = cut(pairs.groupBy("side", "row", "number").agg(F.max_by(F.struct(*rest), F.struct("n", "their_start")).alias("p"))
                .select("side", "row", "number", "p.*"), "passage_pairs")
    return _pieces(near, chains, asked, pairs, least)


def _pieces(near: DataFrame, chains: DataFrame, asked: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """Segments and ends of the chains of at least ``least`` words, in their documents and in the first that has each."""
    beyond = pairs.groupBy("row", "chain").agg(F.sum("n").alias("beyond"))
    whole = cut(chains.join(beyond, ["row", "chain"], "left").where(
        F.col("words") + F.coalesce("beyond", F.lit(0)) >= least).select("row", "chain"), "passage_whole")
    shared = pairs.join(whole, ["row", "chain"])
    mine = shared.select("side", "row", "doc_id", "one", "start", "stop",
                         F.col("my_reach")[F.col("more")].alias("reach"), "first")
    theirs = shared.select("side", F.col("their_row").alias("row"), F.col("their_id").alias("doc_id"), "one",
                           F.col("their_start").alias("start"), F.col("their_stop").alias("stop"),
                           F.col("their_reach")[F.col("more")].alias("reach"), "first")
    pieces = near.where("next_stop is not null").select(
        "row", "doc_id", "chain", "start", F.col("next_stop").alias("stop"), F.col("segment").alias("class_id"),
        F.col("segment_first").alias("first"))
    segment = cut(pieces.join(whole, ["row", "chain"]).drop("chain"), "passage_pieces")
    owners = segment.where("first.row != row").select("class_id", F.col("first.row").alias("row")).distinct()
    segment = segment.union(pieces.drop("chain").join(owners, ["class_id", "row"], "left_semi").select(*segment.columns))
    return segment.unionByName(_end_piece(mine.union(theirs))).distinct()


def _end_piece(df: DataFrame) -> DataFrame:
    """A place's words and those beyond it, as far as they reach."""
    return df.select("row", "doc_id", F.when(F.col("side") == 0, F.col("reach")).otherwise(F.col("start")).alias("start"),
                     F.when(F.col("side") == 1, F.col("reach")).otherwise(F.col("stop")).alias("stop"),
                     F.col("one").alias("class_id"), "first")
