"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance 3 or less have a common neighbour within half the
radius of both (rounded down on one side, up on the other).  Fingerprints emit
such neighbours ("variants"), the shuffle brings equal variants together, and
every group's members are linked to one of them.

What is emitted is cut down without losing a pair:

* At distance 3 the parities differ, so even fingerprints emit their 1-bit
  variants and odd ones their 2-bit variants (both emit 1-bit variants, which
  meet at distance 2).
* Of three differing bits two lie in the same half of the fingerprint, so only
  2-bit variants within a half are needed: 992 instead of 2016.
* Only fingerprints that may have a neighbour emit variants of the whole: with
  3 differing bits one half differs in at most one.  Each half is emitted as it
  is, and by even halves with one bit flipped; a half that only one fingerprint
  arrives at says that it has no neighbour there.

A group shares a variant, so its members lie within a ball: a member within 1
bit of the variant is linked to every other member, at most 3 bits away.  One
link per member joins the whole group, whatever its size; no pairs are formed.
"""

from __future__ import annotations

from itertools import combinations
from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm._shared import bit_map, connected, cut, map_arrow, off_map, on_map

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(x, SEED) for x in map(b" ".join, zip(*(words[i:] for i in range(shingle))))]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _print_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        prints = np.array([fingerprint(t) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
        names = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(prints)], [*names, "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """(doc_id, print): the fingerprint of every row as a signed long; behind (row) with a ``key``."""
    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if key is not None:
        columns = [key.alias("row"), *columns]
    return map_arrow(docs.select(*columns), _print_batches, ("" if key is None else "row long, ") + "doc_id long, print long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


FLIPS_1 = [_signed(1 << i) for i in range(BITS)]
FLIPS_2 = [_signed(1 << i | 1 << j) for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]


def _flips(masks: list[int]):
    return F.array(*[F.lit(m).cast("long") for m in masks])


def candidates(prints: DataFrame) -> DataFrame:
    """The distinct fingerprints of ``prints`` that may have a neighbour (a superset of those that have)."""
    half = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("print").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")),
        F.struct(F.lit(1).alias("side"), F.shiftrightunsigned("print", 32).alias("half"))))
    h = prints.select("print", half.alias("h")).select("print", "h.side", "h.half")
    flips = F.when(F.bit_count("half") % 2 == 0, _flips([0] + [1 << i for i in range(32)])).otherwise(_flips([0]))
    at = h.select("print", "side", "half", F.explode(flips).alias("m")).select(
        "print", (F.col("half").bitwiseXOR(F.col("m")) * 2 + F.col("side")).alias("key"))
    # where just two meet, their distance is known at once
    met = (at.groupBy("key").agg(F.min("print").alias("lo"), F.max("print").alias("hi"), F.count(F.lit(1)).alias("n"))
           .where((F.col("n") > 2) | ((F.col("n") == 2) & (F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= RADIUS)))
           .select("key"))
    return at.join(met, "key", "left_semi").select("print").distinct()


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints within 3 bits, enough to connect all that are linked."""
    odd = F.bit_count("print") % 2 == 1
    masks = F.when(odd, F.concat(_flips([0] + FLIPS_1), F.lit(FLIPS_2))).otherwise(_flips([0] + FLIPS_1))
    v = prints.select("print", F.explode(masks).alias("m")).select(
        F.col("print").bitwiseXOR(F.col("m")).alias("variant"), "print", (F.bit_count("m") <= 1).alias("near"))
    # a variant's group holds distinct fingerprints within 2 bits of it: at most 2,081
    hub = F.min(F.when(F.col("near"), F.col("print"))).over(Window.partitionBy("variant"))
    return (v.withColumn("hub", hub).where((F.col("hub") != F.col("print")))
            .where(F.bit_count(F.col("hub").bitwiseXOR(F.col("print"))) <= RADIUS)
            .select(F.col("hub").alias("a"), F.col("print").alias("b")).distinct())


def _components(docs: DataFrame, id_col: str, text_col: str, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """([row,] doc_id, print) of all rows, and (print, root, component_id) of all distinct fingerprints."""
    rows = cut(fingerprints(docs, id_col, text_col, key), "simhash_prints")
    distinct = rows.groupBy("print").agg(F.min("doc_id").alias("first"))
    few = cut(candidates(distinct.select("print")), "simhash_candidates")
    linked = connected(links(few), "simhash_links")
    rooted = distinct.join(linked.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("component", "print").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows, cut(rooted.join(smallest, "root").select("print", "root", "component_id"), "simhash_components")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents are linked if their fingerprints differ in at most 3 bits;
    component_id is the smallest doc_id reachable, itself included.  Null and
    empty texts have fingerprint zero and are linked like any other; repeated
    rows give equal rows; a row with a null id belongs to the component of its
    fingerprint, whose smallest non-null id counts (null if there is none).
    Other columns aren't read.

    Copies collapse before anything is emitted: the search runs on distinct
    fingerprints, and only the last join meets the rows again (a plain
    sort-merge join that AQE splits where one fingerprint is very common)."""
    rows, of = _components(docs, id_col, text_col)
    return rows.join(of, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns as they were.

    The row with the component's smallest id stays (null ids last; of several
    texts under it, the one with the smallest fingerprint, then digest).  A row
    is an id and a text, so one id on texts of different components keeps a row
    in each; rows that repeat both are one, and the first by a hash of its
    values stays.  Null and empty texts are a component like any other; an empty
    table stays empty.

    What goes is decided on narrow rows.  Texts pass through in place: a row that
    isn't on a bit map of the rows to go stays, one that is on it, but not on a
    map of the rows to stay that it hits by chance, goes.  Only rows on both maps
    (some 6 % of either kind, and repeated ones) are joined exactly."""
    names = docs.columns
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    rows, of = _components(docs, id_col, text_col, key)
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "print", "row")
    stay = cut(rows.join(of, "print").groupBy("root").agg(F.min(rank).alias("best")).select("best.row"), "simhash_stay")
    each = rows.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    each = cut(each.join(stay.withColumn("stays", F.lit(True)), "row", "left").select(
        "row", (F.col("n") > 1).alias("repeated"), F.coalesce("stays", F.lit(False)).alias("stays")), "simhash_rows")
    gone = each.where("repeated or not stays").select("row")
    going, bits = bit_map(gone)
    mistaken = cut(on_map(each.where("stays and not repeated").select("row"), going, bits).select("row"), "simhash_mistaken")
    staying, few = bit_map(mistaken.union(each.where("stays and repeated").select("row")))
    here = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), key.alias("row"))
    sure = off_map(here, going, bits)
    asked = on_map(on_map(here, going, bits), staying, few)
    kept = asked.join(stay, "row", "left_semi")
    plain = [F.col(f"_row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    kept = kept.groupBy("row").agg(F.min_by("_row", F.xxhash64(*plain)).alias("_row"))
    return sure.select("_row.*").unionByName(kept.select("_row.*"))
