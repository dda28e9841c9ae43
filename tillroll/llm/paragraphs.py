"""Substring deduplication: paragraph MinHash banding, verified and clustered.

Two kinds of units are compared across documents:

* paragraphs (lines of at least ``MIN_WORDS`` words), by MinHash over five-word
  shingles.  The number of bands is tuned to the wanted recall at the similarity
  threshold, and all members of a band's group are compared: the pairs of a small
  group are formed; in a large one its smallest member and neighbours are linked
  first, and what these links leave apart is compared by a prefix filter, which
  is exact for the threshold.  Pairs are verified by the exact Jaccard
  similarity, and verified pairs are clustered by connected components.
* passages of 51 words or more, whatever surrounds them and the lines they are laid
  out in (``llm.passages``).

Equal units collapse to one row before anything is paired, so copies cost one
aggregate however many there are.  A document is a pair of id and text.  Removal
is decided unit by unit: the first document that has a unit keeps it, whatever
else of its text repeats, so every class keeps one whole copy.
"""

from __future__ import annotations

import heapq
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm._shared import connected, cut, map_arrow
from tillroll.llm.passages import (M1, RANK, SHINGLE, Stream, blocks, key, mix, on_map, place_digests, shared_passages,
                                   some_of, wanted)

SIMILARITY = 0.8
MIN_WORDS = 25                     # shorter lines are no paragraph
ROWS, RECALL = 5, 0.99
SMALL, BLOCK = 8, 256              # largest group whose pairs are formed; rows of a key that are joined at a time


def tuned_bands(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """The fewest bands of ``rows`` hashes that bring pairs at ``similarity`` together with that recall."""
    bands = 1
    while 1 - (1 - similarity ** rows) ** bands < recall:
        bands += 1
    return bands


class Hashed:
    """Some texts as flat arrays of shingle hashes: of their paragraphs, and of their whole word streams."""

    def __init__(self, rows: list, texts: list[str | None], min_words: int = MIN_WORDS):
        self.rows, self.texts, self.stream = rows, texts, Stream(texts)
        parts = self.stream.parts
        count = parts.line_words
        kept = count >= min_words
        self.sizes, self.owner = count[kept], parts.line_text[kept]
        self.start, self.stop = parts.line_start[kept], parts.line_stop[kept]
        n = len(self.stream.shingle)
        place, line = np.arange(n), np.repeat(np.arange(len(count)), count)
        begin, end = line[:n], line[len(line) - n:]
        whole = (begin == end) & kept[begin]                                   # within one paragraph
        self.hash = self.stream.shingle[whole]
        self.place = place[whole] - (np.cumsum(count) - count)[begin[whole]]
        self.begin = np.cumsum(self.sizes) - self.sizes - np.arange(len(self.sizes)) * (SHINGLE - 1)

    def identities(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit digests of each line's words in order."""
        if not len(self.sizes):
            return self.hash, self.hash
        odd = (2 * self.place + 1).astype(np.uint64)
        return (np.add.reduceat(self.hash * odd, self.begin),
                np.add.reduceat(mix(self.hash ^ M1) * odd, self.begin) ^ self.sizes.astype(np.uint64))

    def bands(self, n_bands: int, rows: int) -> np.ndarray:
        """MinHash bands of each line, one row per line."""
        out = np.zeros((len(self.sizes), n_bands), np.uint64)
        if not len(self.sizes):
            return out
        rng, x = np.random.default_rng(20), np.empty_like(self.hash)
        for band in range(n_bands):
            key = np.full(len(self.sizes), band + 1, np.uint64)
            for _ in range(rows):
                salt, odd = rng.integers(0, 2 ** 64, 2, np.uint64)
                np.bitwise_xor(self.hash, salt, out=x)
                np.multiply(x, odd | np.uint64(1), out=x)
                low = np.minimum.reduceat(x, self.begin)
                key = key * M1 + (low ^ (low >> np.uint64(32)))
            out[:, band] = mix(key)
        return out


def _units(n_bands: int, rows: int, min_words: int = MIN_WORDS):
    names = ["row", "doc_id", "passage", "start", "stop", "n_words", "one", "two", "bands"]

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, ids, texts in blocks(*(b.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                h = Hashed(row, texts, min_words)
                one, two = h.identities()
                n, owner = len(h.sizes), pa.array(h.owner)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * n_bands),
                                                 pa.array(h.bands(n_bands, rows).view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()).take(owner), pa.array(ids, pa.int64()).take(owner),
                     pa.array(np.zeros(n, bool)), pa.array(h.start.astype(np.int32)), pa.array(h.stop.astype(np.int32)),
                     pa.array(h.sizes.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     bands], names)
                at = h.stream.places()
                text, n = pa.array(h.stream.text[at]), len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()).take(text), pa.array(ids, pa.int64()).take(text), pa.array(np.ones(n, bool)), *[pa.nulls(n, pa.int32())] * 3,
                     pa.array(place_digests(h.stream, at).view(np.int64)), pa.nulls(n, pa.int64()),
                     pa.nulls(n, pa.list_(pa.int64()))], names)
    return units


UNITS = ("row long, doc_id long, passage boolean, start int, stop int, n_words int, one long, two long, "
         "bands array<long>")


def _keys_on(map_of, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with ``bands`` -> a row for each band that may be wanted."""
    for b in batches:
        bands = b.column("bands")
        keys = pc.list_flatten(bands)
        hit = pa.array(on_map(map_of, keys.to_numpy().view(np.uint64)))
        rest = b.select([c for c in b.schema.names if c != "bands"]).take(pc.list_parent_indices(bands).take(hit))
        yield rest.append_column("key", keys.take(hit))


def _spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, start) as digests."""
    for b in batches:
        spots = key(b.column("row").to_numpy(), b.column("start").to_numpy(), 0)
        yield pa.RecordBatch.from_arrays([pa.array(spots.view(np.int64))], ["spot"])


def _lines_at(row_map, spot_map, batch: pa.RecordBatch) -> list[str]:
    """Lines (row, start) of the texts that may be wanted."""
    rows, texts = batch.column("row").to_numpy(), batch.column("text")
    keep = on_map(row_map, rows.view(np.uint64))
    split = [(t or "").split("\n") for t in texts.take(pa.array(keep)).to_pylist()]
    lines, count = [x for part in split for x in part], np.array([len(part) for part in split], np.int64)
    size = np.array([len(x) + 1 for x in lines], np.int64)
    start = np.cumsum(size) - size
    start -= np.repeat(start[np.cumsum(count) - count], count)
    return [lines[i] for i in on_map(spot_map, key(np.repeat(rows[keep], count), start, 0)).tolist()]


def _shingle_sets(map_of, where=None, min_words: int = MIN_WORDS):
    """``where``: maps of rows and of spots that the lines are looked for in, otherwise in all texts."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for (texts,) in blocks(_lines_at(*where, b) if where else b.column("text").to_pylist()):
                h = Hashed([], texts, min_words)
                one, two = h.identities()
                hit = on_map(map_of, one)
                found = [np.unique(h.hash[h.begin[i]:h.begin[i] + h.sizes[i] - SHINGLE + 1]).view(np.int64) for i in hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[hit].view(np.int64)), pa.array(two[hit].view(np.int64)),
                     pa.array(found, pa.list_(pa.int64()))], ["one", "two", "shingles"])
    return sets


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, unit) in order -> pairs of units that are first or second neighbours in a group."""
    held: list[tuple] = []
    for b in batches:
        rows = held + list(zip(b.column("key").to_pylist(), b.column("unit").to_pylist()))
        pairs = [(x[1], y[1]) for lag in (1, 2) for x, y in zip(rows, rows[lag:]) if x[0] == y[0] and x[1] != y[1]]
        held = rows[-2:]
        yield pa.RecordBatch.from_arrays([pa.array([min(p) for p in pairs], pa.int64()),
                                          pa.array([max(p) for p in pairs], pa.int64())], ["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    both = (pairs.join(sets.select(F.col("unit").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("unit").alias("b"), F.col("shingles").alias("y")), "b"))
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("a", "b")


def prefix_pairs(sets: DataFrame, linked: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of units of different components that may be near; none that is near is missing.

    In any common order of the shingles, sets at similarity t share one among
    the first n - t n + 1 of the larger set and the first n - 2 t n / (1 + t) + 1
    of the smaller; rare shingles come first, so that few pairs meet.  What
    follows the shared place bounds the overlap.  Of a shingle's units, those
    within its largest component aren't joined to each other; the others are, in
    sub-blocks of about ``block`` rows a side, so no task holds them all."""
    tokens = sets.select("unit", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = (tokens.join(often, "shingle").groupBy("unit", "n")
              .agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("ranked")))

    def first(share: float):                          # places of a prefix
        return F.col("n") - F.ceil(F.col("n") * F.lit(share) - F.lit(1e-9)) + 1
    overlap = 2 * similarity / (1 + similarity)
    prefix = (ranked.select("unit", "n", F.posexplode(F.slice("ranked", F.lit(1), first(similarity).cast("int")))
                            .alias("place", "token")).where("token.often > 1")
              .join(linked.select(F.col("node").alias("unit"), "component"), "unit", "left")
              .select(F.col("token.shingle").alias("shingle"), "unit", "n", "place",
                      F.coalesce("component", "unit").alias("component"), (F.col("place") < first(overlap)).alias("early")))
    prefix = cut(prefix, "paragraph_prefixes")
    parts = prefix.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("rows"), F.max("early").alias("early"))
    keys = (parts.groupBy("shingle").agg(F.sum("rows").alias("rows"), F.max(F.struct("rows", "component")).alias("top"),
                                         F.max("early").alias("early"))
            .where("early and rows > top.rows"))
    keys = keys.select("shingle", F.col("top.component").alias("major"), F.ceil(F.col("rows") / block).cast("int").alias("all"),
                       F.ceil((F.col("rows") - F.col("top.rows")) / block).cast("int").alias("others"))
    met = cut(prefix.join(keys, "shingle").withColumn("other", F.col("component") != F.col("major")), "paragraph_met")

    def joined(left, lefts: str, right, rights: str):
        spot = F.xxhash64("unit")
        x = left.select("shingle", F.pmod(spot, lefts).cast("int").alias("i"),
                        F.explode(F.sequence(F.lit(0), F.col(rights) - 1)).alias("j"),
                        *[F.col(c).alias(f"{c}_x") for c in ("unit", "n", "place", "component")])
        y = right.select("shingle", F.explode(F.sequence(F.lit(0), F.col(lefts) - 1)).alias("i"),
                         F.pmod(spot, rights).cast("int").alias("j"),
                         *[F.col(c).alias(f"{c}_y") for c in ("unit", "n", "place", "component")])
        enough = (F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y"))
                  >= (F.col("n_x") + F.col("n_y")) * (overlap / 2) - 1e-9)
        return (x.join(y, ["shingle", "i", "j"])
                .where((F.struct("n_x", "unit_x") < F.struct(F.col("n_y").alias("n_x"), F.col("unit_y").alias("unit_x")))
                       & (F.col("component_x") != F.col("component_y"))
                       & (F.col("n_x") >= F.col("n_y") * similarity - 1e-9) & enough)
                .select(F.least("unit_x", "unit_y").alias("a"), F.greatest("unit_x", "unit_y").alias("b")))
    return (joined(met.where("early and other"), "others", met, "all")
            .union(joined(met.where("early and not other"), "all", met.where("other"), "others")).distinct())


def near_pairs(docs: DataFrame, distinct: DataFrame, similarity: float, min_words: int = MIN_WORDS) -> DataFrame:
    """Verified pairs (a, b) of the distinct paragraphs (unit, bands).

    All pairs of the groups are judged, except those that verified pairs connect
    already.  ``distinct`` may have copies, and where each stands (row, start):
    then a unit's words are read at one such place, otherwise all texts are
    searched for them."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = (distinct.select("unit", F.explode("bands").alias("key")).groupBy("key")
              .agg(F.min("unit").alias("hub"), F.max("unit").alias("top")).where("hub != top").select("key", "hub"))
    groups = cut(groups, "paragraph_hubs")
    # only bands on a bit map of bounded size meet the groups
    placed = "start" in distinct.columns
    at = F.struct("row", "start") if placed else F.lit(None)
    keys = map_arrow(distinct.select("unit", "bands", *["row", "start"] * placed), partial(_keys_on, wanted(groups, "key")),
                     "unit long, " + "row long, start int, " * placed + "key long")
    keys = cut(keys.join(groups, "key").groupBy("key", "hub", "unit").agg(F.min(at).alias("at")), "paragraph_keys")
    met = cut(keys.join(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "key"), "paragraph_groups")
    few, many = met.where(F.col("members") <= SMALL), met.where(F.col("members") > SMALL)
    order = many.select("key", "unit").repartitionByRange(tasks, "key", "unit").sortWithinPartitions("key", "unit")
    pairs = (few.select("key", F.col("unit").alias("a")).join(few.select("key", F.col("unit").alias("b")), "key")
             .where("a < b").select("a", "b")
             .union(many.where("hub != unit").select(F.col("hub").alias("a"), F.col("unit").alias("b")))
             .union(map_arrow(order, _neighbours, "a long, b long")).distinct())
    pairs = cut(pairs, "paragraph_pairs")
    # the shingles of the paragraphs in pairs, found again in the texts through bit maps of bounded size
    asked = cut(met.groupBy("unit").agg(F.min("at").alias("at")), "paragraph_asked")
    where = None
    if placed:
        spots = asked.select("at.row", "at.start")
        where = wanted(spots.select("row").distinct(), "row"), wanted(map_arrow(spots, _spots, "spot long"), "spot")
    asked = asked.select("unit")
    sets = map_arrow(docs, _shingle_sets(wanted(asked, "unit"), where, min_words), "one long, two long, shingles array<long>")
    # copies go before the exchange: a very common paragraph is one row a task
    sets = cut(sets.dropDuplicates(["one"]).join(asked.withColumnRenamed("unit", "one"), "one", "left_semi")
               .select(F.col("one").alias("unit"), "shingles"), "paragraph_shingles")
    near = cut(_verified(pairs, sets, similarity), "paragraph_near")
    large = many.select("unit").distinct()
    if large.isEmpty():
        return near
    rest = prefix_pairs(sets.join(large, "unit", "left_semi"), connected(near, "paragraph_near_links"), similarity)
    return near.union(_verified(cut(rest, "paragraph_prefix_pairs"), sets, similarity))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL,
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated span of a document: doc_id, start, stop, n_units, first_doc, class_ids, removed.

    Units are paragraphs (lines of ``min_words`` words or more, near ones
    connected to classes) and pieces of shared passages.  A span is a stretch of
    overlapping units; start and stop are code points.  ``removed`` says that an
    earlier document has it: ``first_doc``, the smallest one, which keeps it.
    Where that changes, a new span begins, so a span is to go or to stay as a
    whole.  Spans that stay name their own document.  ``class_ids`` names the
    units' classes.  Spans of clean documents don't appear.

    A document is a pair of id and text: rows that repeat both are one document
    and its spans come once; other texts under the same id are other documents.
    Null ids come last, told apart by their texts.  Null and empty texts have no
    units; repeats within one document are left alone; an empty table gives an
    empty result; other columns aren't read."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    narrow = narrow.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    units = cut(map_arrow(narrow, _units(tuned_bands(similarity, rows, recall), rows, min_words), UNITS), "paragraph_units")
    span = F.min("row").alias("lo"), F.max("row").alias("hi")
    paragraphs = units.where("not passage").drop("passage", "n_words")
    linked = connected(near_pairs(narrow, paragraphs.select(F.col("one").alias("unit"), "bands", "row", "start"),
                                  similarity, min_words), "paragraph_links")
    # only paragraphs with copies or near ones go on
    copies = paragraphs.groupBy("one", "two").agg(*span).where("lo != hi").select("one")
    copies = cut(copies.union(linked.select("node")).distinct(), "paragraph_copies")
    paragraphs = paragraphs.drop("bands")
    paragraphs = map_arrow(paragraphs, partial(some_of, wanted(copies, "one"), "one"), paragraphs.schema)
    paragraphs = cut(paragraphs.join(copies, "one", "left_semi"), "paragraph_some")
    distinct = cut(paragraphs.groupBy("one", "two").agg(*span, F.expr(f"min({RANK})").alias("first")), "paragraph_distinct")
    classes = distinct.join(linked.select(F.col("node").alias("one"), "component"), "one", "left")
    classes = classes.withColumn("class_id", F.coalesce("component", "one"))
    whole = (classes.groupBy("class_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("first").alias("first"))
             .where("lo != hi").select("class_id", "first"))
    repeated = cut(classes.select("one", "two", "class_id").join(whole, "class_id"), "paragraph_repeated")
    pieces = paragraphs.select("row", "doc_id", "start", "stop", "one", "two").join(repeated, ["one", "two"]).select(
        "row", "doc_id", "start", "stop", "class_id", "first")
    pieces = pieces.unionByName(shared_passages(narrow, units.where("passage").select("row", "doc_id", "one")))
    pieces = cut(pieces.distinct(), "paragraph_pieces")
    ordered = (pieces.select("row", "doc_id", "start", "stop", "class_id", "first.unnamed", F.col("first.doc_id").alias("first_id"),
                             F.col("first.row").alias("first_row"))
               .repartition("row").sortWithinPartitions("row", "start", "stop", "class_id"))
    return map_arrow(ordered, _spans, "doc_id long, start int, stop int, n_units long, first_doc long, "
                     "class_ids array<long>, removed boolean")


def stretches(own: tuple, pieces: list[tuple]) -> list[tuple]:
    """(start, stop, number of pieces, first, class ids, removed) of the stretches of one document's pieces
    (start, stop, class id, first); ``own`` is the document as it would stand in ``first``.

    A word that the document is the first to have in any piece stays; a word that
    only repeats earlier documents goes."""
    events = sorted([(p[0], 1, i) for i, p in enumerate(pieces)] + [(p[1], 0, i) for i, p in enumerate(pieces)])
    out, active, heap, keeps, last = [], set(), [], 0, None
    for k, (at, opens, i) in enumerate(events):      # at a place, pieces end before others begin
        if opens:
            active.add(i)
            keeps += pieces[i][3] == own
            heapq.heappush(heap, (pieces[i][3], i))
        else:
            active.discard(i)
            keeps -= pieces[i][3] == own
        until = events[k + 1][0] if k + 1 < len(events) else at
        if until == at or not active:
            continue
        while heap[0][1] not in active:
            heapq.heappop(heap)
        first = own if keeps else heap[0][0]
        if last and last[1] == at and last[2] == first:
            last[1] = until
            last[3] |= active
        else:
            last = [at, until, first, set(active)]
            out.append(last)
    return [(a, b, len(ids), first, sorted({pieces[i][2] for i in ids}), first != own) for a, b, first, ids in out]


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of pieces in order of documents -> spans, a document at a time (its pieces are bounded by its text)."""
    row, doc, held, out = None, None, [], []

    def leave():
        if held:
            out.extend((doc, *s) for s in stretches((doc is None, doc or 0, row), held))
            held.clear()

    def batch():
        done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
            zip(*[(d, a, b, n, None if f[0] else f[1], c, r) for d, a, b, n, f, c, r in out]),
            (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.bool_()))],
            ["doc_id", "start", "stop", "n_units", "first_doc", "class_ids", "removed"])
        out.clear()
        return done

    for b in batches:
        for r, d, start, stop, class_id, *first in zip(*(c.to_pylist() for c in b.columns)):
            if r != row:
                leave()
                row, doc = r, d
            held.append((start, stop, class_id, (first[0], first[1] or 0, first[2])))
        if out:
            yield batch()
    leave()
    if out:
        yield batch()
