"""Toxicity of texts that may be disguised: decode first, then score.

Channel model: a writer replaces letters by look-alike signs, puts separators
between the letters of a word, or repeats letters.  Every disguised token
becomes a lattice of what may have been meant; Viterbi finds the path that the
channel and a character trigram model of the whole corpus make likeliest.

Score: a word's evidence is the best of its own and its character n-grams'
cautious log-odds, learnt from labelled texts; a logistic model of a text's
strongest evidence gives the score.  It is fitted on evidence that leaves the
text's own label out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm._shared import cut, map_arrow
from tillroll.session import unique_name

#: Labelled texts that the classifier learns from, at most (chosen by hash), and features that it keeps.
MAX_LABELLED, MAX_FEATURES = 50_000, 1 << 16
FOLDS, HELD_OUT = 5, 0

# Signs and the letters they stand for.
SIGNS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l", "¡": "i", "(": "c",
    "ø": "o", "µ": "u", "×": "x",
}
SEPARATORS = " ._-*/~,"
#: Costs of the channel in nats: a sign, each further letter it may stand for, a dropped second letter,
#: a letter meant twice where it stands three times or more, a separator between single
#: letters that was meant as one, a digit among letters that was meant as one.
SIGN_COST, CHOICE_COST, DROP_COST, TWICE_COST, GAP_COST, DIGIT_COST = 1.5, 0.3, 4.0, 0.5, 3.0, 4.0

# --- character model -----------------------------------------------------------------------------------------

EDGE, OTHER, DIGIT, BITS = 0, 60, 61, 6
_SIZE = 1 << BITS


def _symbol(c: str) -> int:
    """One of 62 symbols: word edge, a-z, the letters from ß to ÿ, other letters, digits."""
    if "a" <= c <= "z":
        return ord(c) - 96
    if "ß" <= c <= "ÿ" and c != "÷":
        return 27 + ord(c) - 0xDF
    return DIGIT if c.isdecimal() else OTHER if c.isalpha() else EDGE


_TABLE = np.array([_symbol(chr(c)) for c in range(0x3000)] + [OTHER], np.uint8)


def _trigrams(batches):
    """Trigram counts of a task's texts; every word stands between two edges on either side."""
    total = np.zeros(_SIZE ** 3, np.int64)
    for batch in batches:
        text = "\n".join(t for t in batch.column(0).to_pylist() if t).lower()
        s = _TABLE[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 0x3000)]
        if not len(s):
            continue
        s = s[np.concatenate([[True], (s[1:] != EDGE) | (s[:-1] != EDGE)])]
        s = np.concatenate([[EDGE, EDGE], np.repeat(s, np.where(s == EDGE, 2, 1)), [EDGE, EDGE]]).astype(np.int32)
        total += np.bincount((s[:-2] << 2 * BITS) | (s[1:-1] << BITS) | s[2:], minlength=_SIZE ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["at", "n"])


def character_model(docs: DataFrame, text_col: str = "text", weight: float = 5.0) -> np.ndarray:
    """Costs (negative log probabilities) of a symbol after two others, from all texts.

    2^18 numbers whatever the corpus; a task sends at most one count for each.
    Without texts all symbols are alike."""
    rows = map_arrow(docs.select(text_col), _trigrams, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    three = np.zeros(_SIZE ** 3)
    three[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    three = three.reshape(_SIZE, _SIZE, _SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + _SIZE)
    p = (two + weight * p) / (two.sum(axis=1, keepdims=True) + weight)
    p = (three + weight * p) / (three.sum(axis=2, keepdims=True) + weight)
    return -np.log(p).astype(np.float32)


# --- lattice and Viterbi -------------------------------------------------------------------------------------

_SIGN, _LETTER = "[" + re.escape("".join(SIGNS)) + "]", r"[^\W\d_]"
_ODD = re.compile(rf"(?=.*{_LETTER}).*?(?:({_LETTER})\1|{_SIGN})", re.S)
#: Spots with a choice, fewer than two plain letters apart: elsewhere the path and so the state are settled.
_SPOT = re.compile(rf"(?:({_LETTER})\1+|{_SIGN}+)(?:{_LETTER}??(?:({_LETTER})\2+|{_SIGN}+))*")
_GAP = f"[{re.escape(SEPARATORS)}]"
_MARK = rf"(?:{_LETTER}|{_SIGN})"
_SPACED = re.compile(rf"(?<!{_LETTER}){_MARK}(?:{_GAP}{_MARK}){{3,}}(?!{_LETTER})")
_TWICE, _ENDS = re.compile(r"(.)\1"), ".,;:?\"'"
_RUNS, _WORDS = re.compile(r"(.)\1*", re.S), re.compile(rf"{_LETTER}+")


def lattice(token: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """What each run of equal characters of a token may stand for: (text, cost)."""
    out = []
    for k, run in enumerate(_RUNS.finditer(token)):
        c, n = run[1], len(run[0])
        if spaced and k % 2:
            out.append([("", 0.0), (" ", GAP_COST)])
            continue
        sign = c in SIGNS
        meant = SIGNS[c] if sign else c if c.isalpha() else ""
        options = [(run[0], n * DIGIT_COST * c.isdecimal())] if n < 3 or not meant or sign else []
        for j, letter in enumerate(meant):
            cost = SIGN_COST + j * CHOICE_COST if sign else 0.0
            if n == 1 and sign:
                options.append((letter, cost))
            elif n == 2:
                options += [(letter, cost + DROP_COST)] + [(2 * letter, cost)] * sign
            elif n > 2:
                options += [(letter, cost), (2 * letter, cost + TWICE_COST)]
        out.append(options)
    return out


class Decoder:
    """Restores disguised tokens under a character model; remembers what it restored."""

    KEEP = 300_000

    def __init__(self, costs: np.ndarray):
        self.costs, self.spots, self.symbols = costs.ravel().tolist(), {}, {}

    def viterbi(self, steps: list[list[tuple[str, float]]]) -> str:
        """The cheapest path through the lattice, from one word edge to another.

        The state is the last two symbols; a word edge wipes out what came before."""
        costs, symbols = self.costs, self.symbols
        paths = {EDGE: (0.0, "")}
        for options in steps + [[(" ", 0.0)]]:
            after: dict = {}
            for state, (cost, text) in paths.items():
                for letters, extra in options:
                    x, total = state, cost + extra
                    for c in letters:
                        z = symbols.get(c)
                        if z is None:
                            z = symbols[c] = _symbol(c)
                        if z:
                            total += costs[x << BITS | z]
                            x = (x << BITS | z) & (_SIZE * _SIZE - 1)
                        elif x:                            # further edge signs cost nothing
                            total += costs[x << BITS]
                            x = EDGE
                    old = after.get(x)
                    if old is None or total < old[0]:
                        after[x] = (total, text + letters)
            paths = after
        return min(paths.values())[1][:-1]

    def _spot(self, before: str, spot: str, behind: str) -> str:
        key = (before, spot, behind)
        found = self.spots.get(key)
        if found is None:
            if len(self.spots) >= self.KEEP:
                self.spots.clear()
            fixed = [[[(c, 0.0)] for c in part] for part in (before, behind)]
            text = self.viterbi(fixed[0] + lattice(spot) + fixed[1])
            found = self.spots[key] = text[len(before):len(text) - len(behind)]
        return found

    def token(self, token: str) -> str:
        """A token without white space, restored (lower case).

        Two plain signs settle the state, so every spot is decoded on its own
        between the two signs before and behind it: the same path as over the
        whole token, but short enough to be met again."""
        if len(token) > 6 and sum(map(token.count, SEPARATORS)) > 2:
            token = _SPACED.sub(lambda m: self.viterbi(lattice(m[0], True)), token)
        if not _ODD.match(token):
            return token
        return _SPOT.sub(lambda m: self._spot(token[max(0, m.start() - 2):m.start()], m[0], token[m.end():m.end() + 2]), token)

    def tokens(self, text: str | None) -> list[str]:
        """The tokens of a text; four and more single letters in a row are joined as the lattice says."""
        low = (text or "").lower().split()
        sizes = list(map(len, low))
        if sizes.count(1) < 3:
            return low
        single = [i for i, n in enumerate(sizes) if n == 1]
        out, done, k = [], 0, 0
        while k < len(single):
            end = k + 1
            while end < len(single) and single[end] == single[end - 1] + 1:
                end += 1
            first, last = single[k], single[end - 1] + 1
            if end - k >= 3:                               # marks may stand around the first and the last letter
                run = low[first:last]
                if first > done and len(low[first - 1].strip(_ENDS)) == 1:
                    first -= 1
                    run = [low[first].strip(_ENDS), *run]
                if last < len(low) and len(low[last].strip(_ENDS)) == 1:
                    run.append(low[last].strip(_ENDS))
                    last += 1
                if len(run) >= 4:
                    out += low[done:first]
                    out += _SPACED.sub(lambda m: self.viterbi(lattice(m[0], True)), " ".join(run)).split()
                    done = last
            k = end
        return out + low[done:]

    def words(self, token: str) -> list[str]:
        token = token.strip(_ENDS)
        if token.isalpha():
            return [self.token(token)] if _TWICE.search(token) else [token]
        return _WORDS.findall(self.token(token))


# --- evidence ------------------------------------------------------------------------------------------------

_GRAMS = (4, 5)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of each whole word and of its character 4- and 5-grams, word ends included."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    codes = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(codes)) - starts[owner]
    powers = np.full(int(sizes.max()), _STEP)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashes, owners = [np.add.reduceat(codes * powers[place], starts)], [np.arange(len(words))]
    for n in _GRAMS:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, np.uint64(n))
        for k in range(n):
            h = h * _STEP + codes[k:len(codes) - n + 1 + k]
        at = np.flatnonzero(place[:len(h)] + n <= sizes[owner[:len(h)]])
        hashes.append(h[at])
        owners.append(owner[at])
    hashed = np.concatenate(hashes)
    return ((hashed ^ (hashed >> np.uint64(29))) * _MIX).view(np.int64), np.concatenate(owners)


def _blocks(batch: pa.RecordBatch, most: int = 4_000_000):
    """(texts, labels) of a batch in blocks of some million characters."""
    texts, labels, size = [], [], 0
    for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        texts.append(text)
        labels.append(label)
        size += len(text or "")
        if size >= most:
            yield texts, labels
            texts, labels, size = [], [], 0
    if texts:
        yield texts, labels


def _counts(costs, batches):
    """Per feature the toxic and the other texts that hold it."""
    decode = Decoder(costs.value)
    for batch in batches:
        for texts, labels in _blocks(batch):
            index: dict[str, int] = {}
            known: dict[str, list[int]] = {}
            owners, pairs = [], []
            for text in texts:
                mine: set[int] = set()
                for t in set(decode.tokens(text)):
                    ids = known.get(t)
                    if ids is None:
                        ids = known[t] = [index.setdefault(w, len(index)) for w in decode.words(t)]
                    mine.update(ids)
                owners.append(len(mine))
                pairs.extend(mine)
            if not index:
                continue
            hashed, owner = features(list(index))
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            hashed, number = np.unique(hashed[order], return_inverse=True)
            begin = np.searchsorted(owner, np.arange(len(index) + 1))
            size = np.diff(begin)
            word = np.array(pairs)
            text = np.repeat(np.repeat(np.arange(len(texts)), owners), size[word])
            at = np.repeat(begin[word] - np.cumsum(size[word]) + size[word], size[word]) + np.arange(len(text))
            seen = np.sort(text * len(hashed) + number[at])
            seen = seen[np.concatenate([[True], seen[1:] != seen[:-1]])]
            toxic = np.array(labels, bool)[seen // len(hashed)]
            a, b = (np.bincount(seen[rows] % len(hashed), minlength=len(hashed)) for rows in (toxic, ~toxic))
            yield pa.RecordBatch.from_arrays([pa.array(hashed), pa.array(a), pa.array(b)], ["feature", "a", "b"])


def log_odds(a, b, toxic, clean):
    """Cautious log-odds of a feature in a of ``toxic`` and b of ``clean`` texts: one standard error lower."""
    a, b = np.maximum(a, 0) + 0.5, np.maximum(b, 0) + 0.5
    return np.log(a / (toxic + 1)) - np.log(b / (clean + 1)) - np.sqrt(1 / a + 1 / b)


@dataclass
class Model:
    """What scoring needs: character costs, sorted features with their toxic and clean texts, totals, logistic weights."""
    costs: np.ndarray
    features: np.ndarray
    a: np.ndarray
    b: np.ndarray
    toxic: int
    clean: int
    weights: np.ndarray

    def evidence(self, label: int | None) -> np.ndarray:
        """Evidence of each feature; a text's own ``label`` is taken out of the counts first."""
        own = (0, 0) if label is None else (label, 1 - label)
        return np.maximum(0, log_odds(self.a - own[0], self.b - own[1], self.toxic - own[0], self.clean - own[1]))


_INPUTS, _STRONGEST = 4, 5


class Scorer:
    """Inputs of the logistic model, from the evidence of restored words."""

    KEEP = 600_000

    def __init__(self, model: Model, labels: tuple):
        self.model, self.labels, self.decode = model, labels, Decoder(model.costs)
        self.weights = [model.evidence(label) for label in labels]
        self.maybe = np.zeros(1 << 20, bool)               # features by their low bits: most hashes end here
        self.maybe[model.features & (len(self.maybe) - 1)] = True
        self.idle: set[str] = set()                        # tokens without evidence
        self.known: dict[str, list[tuple]] = {}            # token -> (word, evidence by label) of its words that have some

    def _learn(self, tokens: list[str]) -> None:
        words = [self.decode.words(t) for t in tokens]
        index = {w: i for i, w in enumerate({w for ws in words for w in ws})}
        best = np.zeros((len(index), len(self.labels)))
        if index and len(self.model.features):
            hashed, owner = features(list(index))
            some = np.flatnonzero(self.maybe[hashed & (len(self.maybe) - 1)])
            at = np.minimum(np.searchsorted(self.model.features, hashed[some]), len(self.model.features) - 1)
            hit = self.model.features[at] == hashed[some]
            for k, weights in enumerate(self.weights):
                np.maximum.at(best[:, k], owner[some[hit]], weights[at[hit]])
        useful = best.any(axis=1).tolist()
        for t, ws in zip(tokens, words):
            found = [(w, best[index[w]]) for w in ws if useful[index[w]]]
            if found:
                self.known[t] = found
            else:
                self.idle.add(t)

    def inputs(self, texts: list, labels: list) -> np.ndarray:
        """One row a text: 1, its strongest word's evidence, the next four words', log of its number of tokens."""
        if len(self.idle) + len(self.known) > self.KEEP:
            self.idle, self.known = set(), {}
        sizes, left = [], []
        for text in texts:
            tokens = self.decode.tokens(text)
            sizes.append(len(tokens))
            left.append(set(tokens) - self.idle)
        self._learn(list(set().union(*left) - self.known.keys()))
        out = np.zeros((len(texts), _INPUTS))
        for row, size, mine, label in zip(out, sizes, left, labels):
            k = self.labels.index(label)
            words = {w: e[k] for t in mine if t in self.known for w, e in self.known[t]}
            best = sorted(words.values(), reverse=True)[:_STRONGEST]
            row[:] = 1.0, best[0] if best else 0.0, sum(best[1:]), np.log1p(size)
        return out


def _evidence(model, batches):
    scorer = Scorer(model.value, (0, 1))
    for batch in batches:
        for texts, labels in _blocks(batch):
            yield pa.RecordBatch.from_arrays([pa.array(scorer.inputs(texts, labels).tolist(), pa.list_(pa.float64())),
                                              pa.array(labels, pa.int32())], ["x", "toxic"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps on scaled inputs, the first (constant) one without a penalty."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x, w = x / scale, np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def _train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, toxic) of labelled documents outside the held-out fold, each distinct text once.

    An id with several labels is toxic if any says so, and so is a text.  More
    than ``MAX_LABELLED`` labelled ids or texts are thinned by hash."""
    ids = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
           .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    ids = cut(ids.orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED), "toxic_ids")
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(ids), "id").withColumn("h", F.xxhash64("text"))
    chosen = texts.groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("id").alias("id"))
    chosen = cut(chosen.orderBy(F.xxhash64("h"), "h").limit(MAX_LABELLED), "toxic_texts")
    same = texts.drop("toxic").join(F.broadcast(chosen), ["h", "id"])      # a row that repeats id and text counts again
    return cut(same.select("text", "toxic"), "toxic_train")


def held_out(doc_id) -> F.Column:
    """Whether a document's label is held out; a null id's is not (it has no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """Character model from all texts, evidence and score from the labelled ones outside the held-out fold.

    With no labelled text, or labels of one kind only, every score is the
    smoothed share of toxic labels."""
    sc = docs.sparkSession.sparkContext
    costs = character_model(docs, text_col)
    train = _train_rows(docs, labels, id_col, text_col)
    sizes = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    base = np.log((toxic + 1) / (clean + 1))
    none = np.zeros(0, np.int64)
    if not toxic or not clean:
        return Model(costs, none, none, none, toxic, clean, np.array([base] + [0.0] * (_INPUTS - 1)))
    counts = (map_arrow(train, partial(_counts, sc.broadcast(costs)), "feature long, a long, b long")
              .groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic + 1)) - F.log(b / (clean + 1)) - F.sqrt(1 / a + 1 / b)
    kept = (counts.where(F.col("a") >= 2).withColumn("odds", odds).where("odds > 0")
            .orderBy(F.desc(F.col("odds") * F.col("a")), "feature").limit(MAX_FEATURES).select("feature", "a", "b").toArrow())
    found = np.array([kept.column(c).to_numpy() for c in ("feature", "a", "b")], np.int64)
    found = found[:, np.argsort(found[0])]
    model = Model(costs, *found, toxic, clean, np.zeros(_INPUTS))
    rows = map_arrow(train, partial(_evidence, sc.broadcast(model)), "x array<double>, toxic int").toArrow()
    x = np.array(rows.column("x").to_pylist())
    model.weights = fit_logistic(x, rows.column("toxic").to_numpy().astype(np.float64))
    return model


_BUILT: dict = {}


def _scored(model, name: str, batches):
    if name not in _BUILT:                # one scorer per worker, not per task: it remembers the words it met
        _BUILT.clear()
        _BUILT[name] = Scorer(model.value, (None,))
    scorer = _BUILT[name]
    for batch in batches:
        scores = [np.zeros(0)]
        for texts, labels in _blocks(pa.RecordBatch.from_arrays([batch.column(2), pa.nulls(batch.num_rows)], ["t", "y"])):
            scores.append(1 / (1 + np.exp(-np.clip(scorer.inputs(texts, labels) @ model.value.weights, -500, 500))))
        score = np.concatenate(scores)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score),
                                          pa.array((score >= 0.5).astype(np.int32))], ["id", "held_out", "score", "predicted"])


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Score of every document: ``id_col``, held_out, score (0 to 1), predicted.

    A null text scores like an empty one; repeated rows are all scored, equal
    texts alike; null ids are kept; further columns are ignored; an empty table
    gives an empty result.  Only the text counts for the score."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col))
    out = map_arrow(rows, partial(_scored, docs.sparkSession.sparkContext.broadcast(model), unique_name("toxicity")),
                    f"id {kind}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_col)
