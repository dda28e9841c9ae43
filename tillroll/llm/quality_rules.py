"""Quality rules with risk-controlled cutoffs.

Statistics of every whole text are compared with cutoffs.  Which cutoffs may be
used is decided on labelled holdout rows: for each stratum, rule and candidate
cutoff the number of good rows that the rule would reject gives an exact
(Clopper-Pearson) upper bound of its false-rejection rate.  A cutoff is allowed
only if that bound, at a level divided by the number of all tests (Bonferroni),
stays under the rule's share of the allowed risk.  Whatever is picked from the
allowed cutoffs, then, all rules together falsely reject at most ``risk`` of a
stratum's good rows, in all strata at once, with probability 1 - ``delta``.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillroll.llm._shared import cut, map_arrow

# fixed values of the contract
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_exclaim", "top_word")


@dataclass(frozen=True)
class Rule:
    """Rejects rows whose statistic lies above (or below) a cutoff."""
    name: str
    stat: str                      # SQL expression over the counts
    cutoffs: tuple[float, ...]     # candidates, from the loosest to the strictest
    above: bool = True

    def rejects(self, cutoff: Column) -> Column:
        s = F.expr(self.stat)
        return s > cutoff if self.above else s < cutoff


def _grid(lo: float, hi: float, n: int) -> tuple[float, ...]:
    return tuple(round(hi - (hi - lo) * i / (n - 1), 4) for i in range(n))


RULES = (
    Rule("symbols", "n_symbols / greatest(word_chars, 1)", _grid(0.02, 0.4, 20)),
    Rule("upper", "n_upper / greatest(n_words, 1)", _grid(0.1, 0.9, 17)),
    Rule("exclaim", "n_exclaim / greatest(n_words, 1)", _grid(0.05, 0.8, 16)),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)", _grid(0.05, 0.2, 7)),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)", _grid(0.1, 0.9, 9)),
    Rule("top_word", "top_word / greatest(n_words, 1)", _grid(0.15, 0.6, 10)),
    Rule("short_words", "word_chars / greatest(n_words, 1)", (2.0, 2.5, 3.0, 3.5), above=False),
    Rule("long_words", "word_chars / greatest(n_words, 1)", (20.0, 16.0, 13.0, 11.0)),
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a 5-word window that occurs twice or more (all its places)."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    if n <= 20_000:
        wins = list(zip(*(words[i:] for i in range(WINDOW))))
        seen = set(wins)
        if len(seen) == n:
            return 0
        often = Counter(wins)
        hit = np.fromiter((often[w] > 1 for w in wins), bool, n)
    else:  # the same with ranks instead of tuples, for very long texts
        ids: dict[bytes, int] = {}
        one = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
        key = one
        for i in range(1, WINDOW):
            key = key[:-1] * len(ids) + one[i:]
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        hit = np.bincount(key)[key] > 1
    cover = np.zeros(len(words), bool)
    for i in range(WINDOW):
        cover[i:i + n] |= hit
    return int(cover.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; a null text has no words."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines), sum(map(bytes.isupper, words)), text.count("!"),
            max(Counter(words).values(), default=0))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = _counted(b.column("text"))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("stratum"), b.column("digest"), *counts],
                                         ["doc_id", "stratum", "digest", *COUNTS])


def _counted(texts: pa.Array) -> list[pa.Array]:
    rows = np.array([text_counts(t) for t in texts.cast(pa.string()).to_pylist()], np.int64).reshape(-1, len(COUNTS))
    return [pa.array(rows[:, i]) for i in range(len(COUNTS))]


def _count_rows(text_col: str):
    """The same over whole rows (a struct that holds the text), which pass through."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = _counted(b.column("row").field(text_col))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("stratum"), *counts], ["row", "stratum", *COUNTS])
    return count


def quality_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   stratum: str = "lang") -> DataFrame:
    """One row per document: its id, stratum (null: empty), a digest of its text and the counts of the whole text."""
    text = F.col(text_col).cast("string")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
                         F.xxhash64(text).alias("digest"), text.alias("text"))
    return map_arrow(narrow, _count_batches,
                     "doc_id long, stratum string, digest long, " + ", ".join(f"{c} long" for c in COUNTS))


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the largest rate at which k or fewer of n still have probability ``level``."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) for i in range(k + 1)]
    lo, hi = k / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        terms = [c + i * math.log(p) + (n - i) * math.log1p(-p) for i, c in enumerate(logs)]
        top = max(terms)
        below = math.exp(min(0.0, top + math.log(sum(math.exp(t - top) for t in terms))))
        lo, hi = (p, hi) if below > level else (lo, p)
    return hi


BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def choose_cutoffs(counts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = 0.05,
                   delta: float = 0.05, cost: float = 10.0) -> DataFrame:
    """The cutoffs in force: rows (stratum, rule, cutoff, bound, n_good, false_rejects, true_rejects).

    ``labels`` has (doc_id, good 0/1), one row per document.  The holdout has each
    distinct labelled text of a stratum once, with its worst label: the bound is
    on independent draws, which copies of a text aren't, under one id or several.
    Documents that fail the base check aren't the rules' to reject and stay out
    of it.  Of the allowed cutoffs of a rule the one with the largest
    (bad rejected - cost * good rejected) is taken, the loosest of equals; a
    rule that rejects no labelled bad row of a stratum isn't used there.  Only
    the aggregate (strata x rules x cutoffs rows) reaches the driver, and only of
    strata with good rows enough for a bound to hold at all."""
    held = counts.where(f"not ({BASE_FAILED})").join(labels, "doc_id").groupBy("stratum", "digest").agg(
        F.min("good").alias("good"), *[F.first(c).alias(c) for c in COUNTS])
    held = cut(held.drop("digest"), "quality_holdout")
    sizes = held.groupBy("stratum").agg(F.sum("good").alias("n_good"))
    tests = max(1, sizes.count()) * sum(len(r.cutoffs) for r in rules)
    # without a false rejection the bound at n is 1 - level ** (1 / n)
    least = math.ceil(math.log(delta / tests) / math.log1p(-risk / len(rules)))
    held = held.join(sizes.where(F.col("n_good") >= least).select("stratum"), "stratum", "left_semi")
    # how many of a rule's candidates reject a row: they do so from the strictest on
    n_failed = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.size(F.filter(
        F.array(*[F.lit(c) for c in r.cutoffs]), r.rejects)).alias("n")) for r in rules])
    bins = held.select("stratum", "good", F.explode(n_failed).alias("f")).groupBy(
        "stratum", "good", "f.rule", "f.n").count().collect()
    strata: dict[str, int] = {}
    rejected: dict[tuple, int] = {}
    for x in bins:
        if x.good and x.rule == rules[0].name:
            strata[x.stratum] = strata.get(x.stratum, 0) + x["count"]
        strata.setdefault(x.stratum, 0)
        size = len(next(r.cutoffs for r in rules if r.name == x.rule))
        for i in range(size - x.n, size):
            at = (x.stratum, x.rule, i, x.good)
            rejected[at] = rejected.get(at, 0) + x["count"]
    out = []
    for stratum, n_good in sorted(strata.items()):
        for r in rules:
            best = None
            for i, c in enumerate(r.cutoffs):
                k, bad = (rejected.get((stratum, r.name, i, g), 0) for g in (1, 0))
                gain = bad - cost * k
                if gain <= 0 or (best and gain <= best[0]):
                    continue
                bound = upper_bound(k, n_good, delta / tests)
                if bound <= risk / len(rules):
                    best = (gain, (stratum, r.name, c, bound, n_good, k, bad))
            if best:
                out.append(best[1])
    return counts.sparkSession.createDataFrame(
        out, "stratum string, rule string, cutoff double, bound double, n_good long, false_rejects long, "
             "true_rejects long")


def verdicts(counts: DataFrame, cutoffs: list, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``counts`` with base_failed, the rules that reject a row (``failed_rules``) and ``kept``."""
    by_rule: dict[str, list] = {}
    for c in cutoffs:
        by_rule.setdefault(c["rule"], []).append(c)
    failed = []
    for r in rules:
        for c in by_rule.get(r.name, []):
            failed.append(F.when((F.col("stratum") == c["stratum"]) & r.rejects(F.lit(c["cutoff"])), F.lit(r.name)))
    names = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return (counts.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("failed_rules", names)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)))


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): one row per labelled document; repeated labels count as their worst."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("good")))


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  stratum: str = "lang", **limits) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, failed_rules, kept.

    Null and empty texts have no words and fail the base check; repeated rows
    are judged alike; a null stratum is the stratum ''; rows without a label are
    judged by their stratum's cutoffs; without labels no rule is in force and the
    base check alone decides; an empty table gives an empty result; further
    columns of ``docs`` are not read.

    The texts are read once: their counts are stored (in the shared folder) and
    both the holdout and the verdicts use those."""
    counts = cut(quality_counts(docs, id_col, text_col, stratum), "quality_counts")
    cutoffs = choose_cutoffs(counts, good_labels(labels), **limits).collect()
    return verdicts(counts, cutoffs)


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 stratum: str = "lang", **limits) -> DataFrame:
    """``docs`` without the rejected rows, all columns as they were.

    Nulls, empty texts, ties and repeated rows: see ``quality_rules``; columns may
    have any names.

    Cutoffs come from the counts of all documents; the verdicts are then taken
    while the texts are scanned a second time, since joining them to the
    verdicts would shuffle every text."""
    counts = quality_counts(docs, id_col, text_col, stratum)
    cutoffs = [r.asDict() for r in choose_cutoffs(counts, good_labels(labels), **limits).collect()]
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                         F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    counted = map_arrow(packed, _count_rows(text_col), StructType(
        packed.schema.fields + [StructField(c, LongType()) for c in COUNTS]))
    return verdicts(counted, cutoffs).where("kept").select("row.*")
