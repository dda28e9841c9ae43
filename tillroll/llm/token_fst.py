"""Token counts by a transducer compiled from a byte-pair vocabulary.

A vocabulary whose merges go by the score of the merged piece (best first,
leftmost first) is turned into a deterministic transducer over characters.
Its transitions carry the change of the token count, so a text's count is the
sum along its path; no token is ever built.

What a state holds.  A token sequence is the encoding of its text exactly if
every two neighbours, encoded alone, stay as they are: the first merge across a
border depends on the two tokens there only.  So the last token of a prefix's
encoding is the one piece that ends there and agrees with the last token before
it.  Future characters can only complete pieces whose beginning is a suffix of
what was read; for each such suffix the state keeps the last token before it
(forgotten where it can't disagree with any completion) and how many tokens lie
since.  States are numbered as they are first reached, and transitions are
compiled on first use into an open-addressing table of numpy arrays.

Texts are cut into chunks.  All chunks run in lockstep, each from the state that
the 64 characters before it lead to; nearly always that is the state in which the
chunk before ends, and the counts add up.  In a text where it isn't, the chunks'
state maps (entry state -> exit state, count) are evaluated at all states that
occur, equal chunks once, until no new state turns up; then the maps are composed
by a parallel prefix scan, two by two in a logarithmic number of steps.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm._shared import map_arrow

LIMIT = 4096
CHUNK = 512
WARM_UP = 64
AT_ONCE = 1 << 21          # code points that run in lockstep
MOST_TRANSITIONS = 1 << 20  # compiled transitions that a worker keeps; it starts anew beyond
MOST_LANES = 1 << 16       # evaluated maps (distinct chunks x states) of a text
SPACE = "▁"
START = ("", ((0, "", 0),))


class Vocabulary:
    """Pieces with their scores, and what the compilation asks about them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto
        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kind = model.normalizer_spec, proto.ModelProto.SentencePiece
        if (model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback
                or norm.name != "identity" or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or model.trainer_spec.treat_whitespace_as_suffix
                or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces)):
            raise ValueError(f"{path}: only byte-fallback BPE models with the identity normalizer are compiled")
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        self.prefixes = {p[:i] for p in self.score for i in range(1, len(p))}   # what can still become a piece
        self.alone: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.quiet: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The encoding of a short text, by the definition."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def is_token(self, s: str) -> bool:
        if len(s) == 1:
            return True
        found = self.alone.get(s)
        if found is None:
            found = self.alone[s] = s in self.score and self.merge(s) == [s]
        return found

    def agree(self, a: str, b: str) -> bool:
        """Whether tokens a and b stay as they are side by side."""
        if not a:
            return True
        found = self.pairs.get((a, b))
        if found is None:
            found = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return found

    def harmless(self, a: str, s: str) -> bool:
        """Whether no piece that begins with s can merge across a border with the token a."""
        found = self.quiet.get((a, s))
        if found is None:
            found = self.quiet[a, s] = not any(
                u + s in self.prefixes or any(u + s[:k] in self.score for k in range(1, len(s) + 1))
                for u in (a[i:] for i in range(len(a))))
        return found

    def cost(self, token: str) -> int:
        """Tokens that a piece counts for: one, or its bytes if the vocabulary lacks it."""
        return 1 if token in self.score else len(token.encode("utf-8", "surrogatepass"))

    def follow(self, state: tuple, char: str) -> tuple[tuple, int]:
        """(next state, change of the count) on reading ``char``."""
        text, entries = state
        kept, last, count = [], None, 0
        for length, before, since in entries:            # longest first
            s = text[len(text) - length:] + char
            if last is None and self.is_token(s) and self.agree(before, s):
                last, count = s, since + self.cost(s)
            if s in self.prefixes:
                kept.append((length + 1, before if not before or not self.harmless(before, s) else "", since))
        entries = tuple((n, before, since - count) for n, before, since in kept) + ((0, last, 0),)
        longest = entries[0][0]
        return ((text + char)[-longest:] if longest else "", entries), count


class Transducer:
    """States and transitions compiled so far, with vectorised steps."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.reset()

    def reset(self) -> None:
        self.states, self.number = [START], {START: 0}
        self._table(1 << 16)
        self.used = 0

    def _table(self, size: int) -> None:
        self.size = size
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys * np.int64(-7046029254386353131)
        return ((mixed ^ (mixed >> np.int64(29))) >> np.int64(13)) & np.int64(self.size - 1)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        for k, v, at in zip(keys.tolist(), values.tolist(), self._slots(keys).tolist()):
            while self.keys[at] >= 0:
                at = (at + 1) & (self.size - 1)
            self.keys[at], self.values[at] = k, v

    def _compile(self, keys: np.ndarray) -> None:
        """Add the transitions of the distinct ``keys``."""
        values = []
        for k in keys.tolist():
            state, count = self.vocabulary.follow(self.states[k >> 21], chr(k & 0x1FFFFF))
            number = self.number.get(state)
            if number is None:
                number = self.number[state] = len(self.states)
                self.states.append(state)
            values.append(number << 8 | (count + 128))
        self.used += len(values)
        values = np.array(values, np.int64)
        if self.used * 4 > self.size:
            old = self.keys >= 0
            keys, values = np.append(keys, self.keys[old]), np.append(values, self.values[old])
            self._table(1 << (self.used * 8).bit_length())
        self._put(keys, values)

    def step(self, states: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, changes of the counts), for many lanes at once."""
        keys = (states << 21) | chars
        while True:
            at = self._slots(keys)
            seen = self.keys[at]
            wrong = np.flatnonzero(seen != keys)
            missing = []
            while len(wrong):
                empty = seen[wrong] < 0
                missing.append(wrong[empty])
                wrong = wrong[~empty]
                at[wrong] = (at[wrong] + 1) & (self.size - 1)
                seen[wrong] = self.keys[at[wrong]]
                wrong = wrong[seen[wrong] != keys[wrong]]
            missing = np.concatenate(missing) if missing else wrong
            if not len(missing):
                values = self.values[at]
                return values >> 8, (values & 255) - 128
            self._compile(np.unique(keys[missing]))

    def run(self, states: np.ndarray, chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(exit states, counts) of lanes chars[start:start + length], the longest lane first."""
        states, counts = states.copy(), np.zeros(len(states), np.int64)
        active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
        for t, n in enumerate(active.tolist()):          # lanes that have more than t characters
            states[:n], change = self.step(states[:n], chars[starts[:n] + t])
            counts[:n] += change
        return states, counts

    def count(self, texts: list[str | None]) -> np.ndarray:
        """The number of tokens of each text."""
        if self.used > MOST_TRANSITIONS:
            self.reset()
        full = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        chars = np.frombuffer("".join(full).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.array([len(t) for t in full], np.int64)
        n_chunks = -(-sizes // CHUNK)
        owner = np.repeat(np.arange(len(full)), n_chunks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        starts = (np.cumsum(sizes) - sizes)[owner] + nth * CHUNK
        lengths = np.minimum(CHUNK, sizes[owner] - nth * CHUNK)
        entry = np.zeros(len(owner), np.int64)
        later = np.flatnonzero(nth > 0)
        entry[later] = self.run(entry[later], chars, starts[later] - WARM_UP, np.full(len(later), WARM_UP))[0]
        order = np.argsort(-lengths, kind="stable")
        exits, counts = np.empty_like(entry), np.empty_like(entry)
        exits[order], counts[order] = self.run(entry[order], chars, starts[order], lengths[order])
        off = later[exits[later - 1] != entry[later]]
        total = np.bincount(owner, counts, len(full)).astype(np.int64)
        for text in np.unique(owner[off]).tolist():
            total[text] = self._scan(chars, *(a[owner == text] for a in (starts, lengths, entry, exits, counts)))
        return total

    def _scan(self, chars: np.ndarray, starts, lengths, entry, exits, counts) -> int:
        """The count of one text whose chunks weren't all entered in the state supposed."""
        number: dict[bytes, int] = {}
        kind = np.array([number.setdefault(chars[a:a + n].tobytes(), len(number)) for a, n in zip(starts, lengths)])
        _, first = np.unique(kind, return_index=True)       # kinds are numbered as they are met
        states = np.unique(np.concatenate([[0], entry, exits]))
        exit_of, count_of = np.zeros((len(first), 0), np.int64), np.zeros((len(first), 0), np.int64)
        done = 0
        while done < len(states):                          # evaluate the maps, new states after old ones
            if len(states) * len(first) > MOST_LANES:
                return self._one_by_one(chars, starts, lengths, entry, exits, counts)
            new = states[done:]
            lane = np.repeat(first, len(new))
            order = np.argsort(-lengths[lane], kind="stable")
            out, n = np.empty(len(lane), np.int64), np.empty(len(lane), np.int64)
            out[order], n[order] = self.run(np.tile(new, len(first))[order], chars, starts[lane][order], lengths[lane][order])
            exit_of = np.hstack([exit_of, out.reshape(len(first), -1)])
            count_of = np.hstack([count_of, n.reshape(len(first), -1)])
            done = len(states)
            states = np.concatenate([states, np.setdiff1d(out, states)])
        place = np.argsort(states)
        maps = place[np.searchsorted(states, exit_of, sorter=place)][kind]   # chunk x entry -> exit, as numbers
        sums, step = count_of[kind], 1
        while step < len(kind):                            # after each step a map covers twice as many chunks
            inner = maps[:-step]
            sums[step:] = sums[:-step] + np.take_along_axis(sums[step:], inner, axis=1)
            maps[step:] = np.take_along_axis(maps[step:], inner, axis=1)
            step *= 2
        return int(sums[-1, int(np.flatnonzero(states == 0)[0])])

    def _one_by_one(self, chars, starts, lengths, entry, exits, counts) -> int:
        """The same chunk after chunk, where too many states occur to evaluate all maps."""
        entry, exits, counts = entry.copy(), exits.copy(), counts.copy()
        for i in range(1, len(entry)):
            if exits[i - 1] != entry[i]:
                found = self.run(exits[i - 1:i], chars, starts[i:i + 1], lengths[i:i + 1])
                exits[i], counts[i] = found[0][0], found[1][0]
        return int(counts.sum())


_COMPILED: dict[str, Transducer] = {}


def _count(path: str, limit: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _COMPILED.get(path) or _COMPILED.setdefault(path, Transducer(path))
        for b in batches:
            texts = b.column("text").to_pylist()
            found, at = [], 0
            while at < len(texts):
                part, size = [], 0
                while at < len(texts) and size < AT_ONCE:
                    part.append(texts[at])
                    size, at = size + len(texts[at] or ""), at + 1
                found.append(machine.count(part))
            n = np.concatenate(found) if found else np.zeros(0, np.int64)
            n_bytes = pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n_bytes, pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return count


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    Counts are those of the library for the BPE model file ``model``, without
    begin or end tokens, of the whole text; control strings inside texts are
    plain text.  Null and empty texts have no tokens; repeated rows give equal
    rows; other columns aren't read.  There is no shuffle, and a worker's memory
    is bounded by its compiled transitions and ``AT_ONCE``."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(narrow, _count(model, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
