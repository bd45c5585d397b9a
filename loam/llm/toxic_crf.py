"""Operator 2: toxic spans by a linear-chain conditional random field.

A two-state CRF tags every token. A token's potential is a bias plus weights of its features
and of its neighbours': the word, its prefixes and suffixes, its shape. Labels exist for
documents only, so tokens are labelled first: a clean document has no toxic token, in a toxic
one the tokens are that have a feature which toxic documents use significantly more often.
As the fit goes on, forward-backward marginals of the field, given that the document is
toxic, are the expected tags, and toxic documents that have none yet raise the marginals of
their likeliest tokens. An L1 penalty leaves few features with a weight. Scoring runs
forward-backward over the whole texts of many documents side by side: texts are cut into
pieces, products of the moves over a piece carry exactly what comes before and after it.
The marginals give the offending offsets and, through a logistic link, the document's score.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain as chained
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.llm.shared import settings, stage, tidy

#: The model's bounded sample: most labelled rows, most characters of one and of all together.
SAMPLE, LONGEST, SAMPLE_CHARS = 4000, 8000, 4_000_000
PREFIXES, SUFFIXES = (3, 4, 5, 6, 7, 8), (3, 4, 5)
#: Penalty of a weight of the token's own features, and of its neighbours', for each toxic document of the sample.
L1 = (0.003, 0.009)
ROUNDS, BIAS = 48, -6.0
#: Rounds between two estimates of the tags, and how much likelier a token is toxic in a toxic document (log odds).
AGAIN, GIVEN = 12, 2.0
#: Most that a toxic document without toxic tokens asks for, by its marginals.
MISSED = 30.0
#: Log-likelihood ratios by documents that label a feature's tokens, alone or (the first two) together with that by occurrences.
SIGNIFICANT = (8.0, 30.0, 20.0)
#: Weights below this are left out of the model.
LEAST = 0.02
THRESHOLD = 0.3
PIECE = 256
_TOKEN = re.compile(r"[^\W\d_]+")
_CACHE = 200_000
#: Characters of texts read side by side (or one longer text), and tokens of a piece.
_CHARS, _STRETCH = 2_000_000, 64


def held_out(doc_id: Column) -> Column:
    """True if crc32(doc_id as text) mod 4 is 2: such rows are never learned from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _shape(word: str, low: str) -> str:
    return "lower" if word == low else "upper" if word == word.upper() and len(word) > 1 else "title" if word[1:] == low[1:] else "mixed"


def _features(word: str) -> list[str]:
    """The word, its affixes and its shape."""
    low = word.lower()
    own = [f"w:{low}", f"shape:{_shape(word, low)}", f"length:{min(len(low), 20) // 4}"]
    own += [f"p:{low[:n]}" for n in PREFIXES if len(low) > n]
    return own + [f"s:{low[-n:]}" for n in SUFFIXES if len(low) > n]


@dataclass
class Model:
    """Weights by feature (own, from the token before, from the token after), potentials, and the link's weights."""

    weights: dict[str, tuple[float, float, float]]
    emit: np.ndarray  # log potentials of "toxic"; the first one is that of tokens without weighted features
    move: np.ndarray  # 2 x 2 log potentials
    start: np.ndarray
    link: np.ndarray  # bias, weights of the document's aggregates


class _Entries(dict):
    """What words add, by word as written: to their own potential, to the next token's, to that of the one before; None if nothing.

    Filled as words come, emptied when large. The weights of ``_features`` are looked up by kind.
    """

    def __init__(self, model: Model) -> None:
        super().__init__()
        kinds = {"w": {}, "shape": {}, "length": {}, "p": {}, "s": {}}
        for feature, weights in model.weights.items():
            kind, _, name = feature.partition(":")
            kinds[kind][name] = weights
        self.words, self.shapes, lengths, self.prefixes, self.suffixes = kinds.values()
        self.lengths = [lengths.get(str(min(n, 20) // 4)) for n in range(21)]

    def __missing__(self, word: str) -> tuple[float, float, float] | None:
        low = word.lower()
        size, prefix, suffix = len(low), self.prefixes.get, self.suffixes.get
        found = [self.words.get(low), self.shapes.get(_shape(word, low)), self.lengths[min(size, 20)]]
        found += [prefix(low[:n]) for n in PREFIXES if size > n]
        found += [suffix(low[-n:]) for n in SUFFIXES if size > n]
        own, before, after, some = 0.0, 0.0, 0.0, False
        for weights in found:
            if weights is not None:
                own, before, after, some = own + weights[0], before + weights[1], after + weights[2], True
        if len(self) >= _CACHE:
            self.clear()
        self[word] = entry = (own, before, after) if some else None
        return entry


def chains(model: Model, potentials: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """P(toxic) of all tokens of documents, one after the other, from the tokens' log potentials.

    Forward-backward on odds, pieces of ``_STRETCH`` tokens side by side. A piece's product of
    moves gives the odds at which the next one starts, so that the result is that of the whole text.
    """
    if not len(potentials):
        return np.zeros(0)
    (m00, m01), (m10, m11) = np.exp(model.move).tolist()
    s0, s1 = np.exp(model.start).tolist()
    lengths = lengths[lengths > 0]
    pieces = -(-lengths // _STRETCH)
    total, opens = int(pieces.sum()), np.cumsum(pieces) - pieces
    nth = np.arange(total) - np.repeat(opens, pieces)
    sizes = np.minimum(np.repeat(lengths, pieces) - nth * _STRETCH, _STRETCH)
    starts = np.cumsum(sizes) - sizes
    # Longest pieces first, so that those still running at a step are the first ones.
    order = np.argsort(-sizes, kind="stable")
    column = np.empty(total, np.int64)
    column[order] = np.arange(total)
    sizes, starts, nth = sizes[order], starts[order], nth[order]
    long = int(sizes[0])
    alive = (sizes > np.arange(long)[:, None]).sum(1).tolist()
    places = np.minimum(starts + np.arange(long)[:, None], len(potentials) - 1)
    e = np.exp(np.clip(potentials, -60, 60))[places]
    # Products of the moves into a piece's tokens; into a document's first one it is the start, whatever came before.
    first = nth == 0
    t00, t01 = np.where(first, s0, m00), np.where(first, s1, m01) * e[0]
    t10, t11 = np.where(first, s0, m10), np.where(first, s1, m11) * e[0]
    for i in range(1, long):
        m, up = alive[i], e[i, : alive[i]]
        for low, high in ((t00, t01), (t10, t11)):
            a, b = low[:m], high[:m]
            low[:m], high[:m] = a * m00 + b * m10, (a * m01 + b * m11) * up
        if i % 4 == 0:
            whole = t00[:m] + t01[:m] + t10[:m] + t11[:m]
            for t in (t00, t01, t10, t11):
                t[:m] /= whole
    # Odds in front of each piece's first token, and behind its last one; pieces of the same ordinal at once.
    into, behind = np.zeros(total), np.ones(total)
    many = int(pieces.max())
    rank = np.argsort(-pieces, kind="stable")
    firsts, running = opens[rank], (pieces > np.arange(many)[:, None]).sum(1).tolist()
    for k in range(1, many):
        at = column[firsts[: running[k]] + k - 1]
        r = into[at]
        odds = (t01[at] + r * t11[at]) / (t00[at] + r * t10[at])
        into[column[firsts[: running[k]] + k]] = odds
    for k in range(many - 1, 0, -1):
        at = column[firsts[: running[k]] + k]
        q = behind[at]
        behind[column[firsts[: running[k]] + k - 1]] = (t10[at] + t11[at] * q) / (t00[at] + t01[at] * q)
    forward = np.empty((long, total))
    forward[0] = np.where(first, s1 / s0, (m01 + into * m11) / (m00 + into * m10)) * e[0]
    for i in range(1, long):
        m = alive[i]
        r = forward[i - 1, :m]
        forward[i, :m] = (m01 + r * m11) / (m00 + r * m10) * e[i, :m]
    out = np.empty(len(potentials))
    for i in range(long - 1, -1, -1):
        m = alive[i]
        q = behind[:m]
        odds = forward[i, :m] * q
        out[starts[:m] + i] = odds / (1 + odds)
        if i:
            up = e[i, :m] * q
            behind[:m] = (m10 + m11 * up) / (m00 + m01 * up)
    return out


def chain(model: Model, at: list[int], potentials: list[float], total: int) -> np.ndarray:
    """P(toxic) of the tokens ``at`` with their log potentials; all other ``total`` tokens have no weighted feature."""
    dense = np.full(total, float(model.emit[0]))
    dense[at] = potentials
    return chains(model, dense, np.array([total]))[at]


def marginals(model: Model, at: list[int], entries: list[int], total: int) -> np.ndarray:
    """``chain`` with potentials named by their number in ``model.emit``."""
    return chain(model, at, [float(model.emit[e]) for e in entries], total)


def reads(model: Model, entries: _Entries, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Per text (places of tokens with a potential of their own, their P(toxic), number of all tokens)."""
    words = [_TOKEN.findall(t) for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    types = defaultdict(count().__next__)
    codes = np.fromiter(map(types.__getitem__, chained.from_iterable(words)), np.int64, int(lengths.sum()))
    del words
    found = [entries[w] for w in types]
    own = np.array([f or (0.0, 0.0, 0.0) for f in found], float).reshape(-1, 3)[codes]
    special = np.array([f is not None for f in found], bool)[codes]
    ends = np.cumsum(lengths)
    inner = np.ones(len(codes) + 1, bool)  # whether a token follows one of the same text
    inner[ends] = inner[0] = False
    inner = inner[1:-1]
    potentials = own[:, 0] + float(model.emit[0])
    potentials[1:] += own[:-1, 1] * inner
    potentials[:-1] += own[1:, 2] * inner
    special[1:] |= (own[:-1, 1] != 0) & inner
    special[:-1] |= (own[1:, 2] != 0) & inner
    probs = chains(model, potentials, lengths)
    for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
        at = np.flatnonzero(special[end - n : end])
        yield at, probs[end - n : end][at], n


def read(model: Model, entries: _Entries, text: str) -> tuple[list[int], np.ndarray, int]:
    """``reads`` of one text."""
    at, probs, total = next(reads(model, entries, [text]))
    return at.tolist(), probs, total


def _together(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in lists of about ``_CHARS`` characters."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= _CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def aggregates(probs: np.ndarray, total: int) -> np.ndarray:
    """A document's aggregates of its marginals: bias, largest, expected number, expected share."""
    expected = float(probs.sum())
    return np.array([1.0, float(probs.max()) if len(probs) else 0.0, np.log1p(expected), np.log1p(1000 * expected / max(total, 1)) / 5])


def score(model: Model, probs: np.ndarray, total: int) -> float:
    return float(1 / (1 + np.exp(-np.clip(aggregates(probs, total) @ model.link, -30, 30))))


def _ratio(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log-likelihood ratio of seeing something ``a`` times among n1 and ``b`` among n0."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    share = (a + b) / max(n1 + n0, 1)
    return 2 * (part(a, share * n1) + part(b, share * n0) + part(n1 - a, (1 - share) * n1) + part(n0 - b, (1 - share) * n0))


class _Sample:
    """Token types of the sample's documents in pieces side by side, and the types' features."""

    def __init__(self, texts: list[str], labels: list[int]) -> None:
        types: dict[str, int] = {}
        docs = [[types.setdefault(w, len(types)) for w in _TOKEN.findall(t)] for t in texts]
        features: dict[str, int] = {}
        lists = [[features.setdefault(f, len(features)) for f in _features(w)] for w in types]
        held, uses = np.zeros((2, len(features))), np.zeros((2, len(features)))
        for own, label in zip(docs, labels, strict=True):  # documents that hold a feature, and its occurrences
            held[label, list({f for t in set(own) for f in lists[t]})] += 1
            for t in own:
                uses[label, lists[t]] += 1
        seen = held.sum(0)
        n0, n1 = labels.count(0), labels.count(1)
        tokens = [sum(len(own) for own, y in zip(docs, labels, strict=True) if y == label) for label in (0, 1)]
        by_docs, by_uses = _ratio(held[1], held[0], n1, n0), _ratio(uses[1], uses[0], tokens[1], tokens[0])
        alone, both, sure = SIGNIFICANT
        telling = (held[1] * n0 > 6 * (held[0] + 0.5) * n1) & ((by_docs >= sure) | (by_docs >= alone) & (by_uses >= both))
        self.seeds = np.array([bool(telling[own].any()) for own in lists] + [False])
        # A feature of a single document says nothing about others.
        number = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)
        self.names = [f for f, n in zip(features, seen.tolist(), strict=True) if n > 1]
        lists = [[int(number[f]) for f in own if number[f] >= 0] for own in lists]
        self.flat = np.array([f for own in lists for f in own], np.int64)
        self.ends = np.cumsum([len(own) for own in lists]) if lists else np.zeros(0, np.int64)
        self.lens = np.array([len(own) for own in lists], np.int64)
        pieces = [(k, own[at : at + PIECE], at) for k, own in enumerate(docs) for at in range(0, max(len(own), 1), PIECE) if own]
        pieces.sort(key=lambda p: -len(p[1]))
        self.labels, self.count = np.array(labels), len(types)
        self.doc = np.array([k for k, _, _ in pieces], np.int64)
        self.long = max((len(p) for _, p, _ in pieces), default=0)
        # Type ``count`` stands for "no token".
        self.tokens = np.full((self.long, len(pieces)), self.count, np.int64)
        self.before, self.after = self.tokens.copy(), self.tokens.copy()
        for n, (k, own, at) in enumerate(pieces):
            self.tokens[: len(own), n] = own
            self.before[: len(own), n] = [docs[k][at - 1] if at else self.count, *own[:-1]]
            end = at + len(own)
            self.after[: len(own), n] = [*own[1:], docs[k][end] if end < len(docs[k]) else self.count]
        # Pieces are sorted by length, so those still running at a step are the first ones.
        self.alive = (self.tokens < self.count).sum(1)

    def by_type(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each type's features; 0 for "no token"."""
        sums = np.concatenate(([0.0], np.cumsum(weights[self.flat])))
        return np.append(sums[self.ends] - sums[self.ends - self.lens], 0.0)

    def by_feature(self, types: np.ndarray, values: np.ndarray) -> np.ndarray:
        per = np.bincount(types.ravel(), values.ravel(), minlength=self.count + 1)[: self.count]
        return np.bincount(self.flat, np.repeat(per, self.lens), minlength=len(self.names))


def _expect(sample: _Sample, emit: np.ndarray, start: float, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per token P(toxic), per piece the expected moves (0-1, 1-0, 1-1) and toxic starts, and log Z against "no toxic token"."""
    long, n = emit.shape
    e, (t01, t10, t11) = np.exp(np.clip(emit, -30, 30)), np.exp(move)
    alpha, logs = np.zeros((long, 2, n)), np.zeros(n)
    for i in range(long):
        m = sample.alive[i]
        if i:
            a0, a1 = alpha[i - 1, :, :m]
            n0, n1 = a0 + a1 * t10, (a0 * t01 + a1 * t11) * e[i, :m]
        else:
            n0, n1 = np.ones(m), np.exp(start) * e[0, :m]
        whole = n0 + n1
        alpha[i, 0, :m], alpha[i, 1, :m] = n0 / whole, n1 / whole
        logs[:m] += np.log(whole)
    tag, moved = np.zeros((long, n)), np.zeros((3, n))
    b0, b1 = np.ones(n), np.ones(n)
    for i in range(long - 1, -1, -1):
        m = sample.alive[i]
        a0, a1 = alpha[i, :, :m]
        up = a1 * b1[:m]
        tag[i, :m] = up / (a0 * b0[:m] + up)
        if i:
            c0, c1 = b0[:m], b1[:m] * e[i, :m]
            p0, p1 = alpha[i - 1, :, :m]
            parts = np.stack((p0 * t01 * c1, p1 * t10 * c0, p1 * t11 * c1))
            moved[:, :m] += parts / (parts.sum(0) + p0 * c0)
            n0, n1 = c0 + t01 * c1, t10 * c0 + t11 * c1
            whole = n0 + n1
            b0[:m], b1[:m] = n0 / whole, n1 / whole
    return tag, moved, tag[0] if long else np.zeros(n), logs


def _fit_field(sample: _Sample, rounds: int = ROUNDS) -> tuple[np.ndarray, float, float, np.ndarray]:
    """Weights (own, before, after), bias, start and moves: proximal AdaGrad on the likelihood of the expected tags."""
    size = len(sample.names)
    weights, first_guess = np.zeros((3, size)), np.array([BIAS, -1.0, 0.0, 0.0, 0.0])  # bias, start, moves
    other = first_guess.copy()
    power, power_other = np.full((3, size), 1e-2), np.full(5, 1e-2)
    penalty = np.array([L1[0], L1[1], L1[1]])[:, None] * sample.labels.sum()
    kinds = (sample.tokens, sample.before, sample.after)
    alive = sample.tokens < sample.count
    toxic = sample.labels[sample.doc] == 1
    known = sample.seeds[sample.tokens] * toxic
    wanted = known.astype(float)
    for k in range(rounds):
        emit = other[0] + sum(sample.by_type(w)[t] for w, t in zip(weights, kinds, strict=True))
        if k and k % AGAIN == 0:
            wanted = np.maximum(_expect(sample, emit + GIVEN, other[1], other[2:])[0] * toxic, 0.9 * known)
        tag, moved, first, logs = _expect(sample, emit, other[1], other[2:])
        # log Z is measured against "no toxic token": a toxic document that still looks clean asks for more of what is likeliest in it.
        clean = np.exp(-np.clip(np.bincount(sample.doc, logs, minlength=len(sample.labels)), 1e-9, 60))
        asks = np.where(sample.labels == 1, np.minimum(clean / (1 - clean), MISSED), 0.0)[sample.doc]
        off = (wanted - tag + asks * tag) * alive
        grad = np.stack([sample.by_feature(t, off) for t in kinds])
        power += grad**2
        rate = 0.5 / np.sqrt(power)
        weights += rate * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * penalty, 0)
        up, on = wanted[1:] * alive[1:], wanted[:-1] * alive[1:]
        moves = np.array([(up * (1 - on)).sum(), (on * (alive[1:] - up)).sum(), (up * on).sum()])
        more = np.concatenate(([off.sum(), (wanted[0] - first).sum()], moves - moved.sum(1))) - 0.1 * (other - first_guess)
        power_other += more**2
        other += 0.5 * more / np.sqrt(power_other)
    return weights, other[0], other[1], other[2:]


def _fit_link(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small L2 prior, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        w = w + np.linalg.solve(hess, x.T @ (y - p) - 0.05 * w)
    return w


def fitted(read_: list[str], tags: list[int]) -> Model | None:
    """The model of the sample's texts and labels."""
    if len(set(tags)) < 2:
        return None
    held = _Sample(read_, tags)
    if not held.long:
        return None
    weights, bias, start, move = _fit_field(held)
    strong = np.flatnonzero((np.abs(weights) > LEAST).any(0))
    table = {held.names[k]: tuple(weights[:, k].tolist()) for k in strong.tolist()}
    model = Model(table, np.array([bias]), np.array([[0.0, move[0]], [move[1], move[2]]]), np.array([0.0, start]), np.zeros(4))
    entries = _Entries(model)
    x = np.array([aggregates(probs, total) for some in _together(read_) for _, probs, total in reads(model, entries, some)])
    model.link = _fit_link(x, np.array(tags, float))
    return model


def _fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model, pickled, if there is one."""
    tags, texts = [], []
    for batch in batches:
        tags += batch["toxic"].to_pylist()
        texts += batch["text"].to_pylist()
    model = fitted(texts, tags)
    del tags, texts
    tidy()
    if model is not None:
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Model | None:
    """Model from rows that aren't held out; None unless both labels occur.

    At most ``sample`` labelled doc_ids in the order of a hash are used, one row of each (the
    one with the least text, unless it is longer than ``LONGEST``), and of these as many as
    hold ``chars`` characters together. Of labels that disagree for a doc_id, toxic counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(*order).limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.length("text") <= LONGEST)  # broadcast: at most ``sample`` rows
    single = stage(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "labelled")  # repeated doc_ids end here
    # At most ``sample`` rows are left; their running size bounds what one task fits. Only the model reaches the driver.
    size = F.sum(F.length("text")).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = single.select("doc_id", "toxic", "text", size.alias("size")).where(F.col("size") <= chars)
    found = rows.coalesce(1).sortWithinPartitions("size").select("toxic", "text").mapInArrow(_fit, "model binary").collect()
    return pickle.loads(found[0].model) if found else None


def _spans(text: str, bad: set[int]) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of the tokens ``bad``."""
    starts, ends, last = [], [], -2
    if bad:
        for i, m in enumerate(_TOKEN.finditer(text)):
            if i in bad:
                if last == i - 1:
                    ends[-1] = m.end()
                else:
                    starts.append(m.start())
                    ends.append(m.end())
                last = i
    return starts, ends


def tags(model: Model | None, texts: Iterable[str | None], entries: _Entries | None = None) -> Iterator[tuple[float, list[int], list[int]]]:
    """Per text (score, starts, ends): offsets in code points of runs of tokens with marginal 0.5 or more; null is empty."""
    if model is None:
        for _ in texts:
            yield 0.0, [], []
        return
    entries = _Entries(model) if entries is None else entries
    for some in _together(t or "" for t in texts):
        for text, (at, probs, total) in zip(some, reads(model, entries, some), strict=True):
            yield score(model, probs, total), *_spans(text, set(at[probs >= 0.5].tolist()))


def tag(model: Model | None, text: str | None, entries: _Entries | None = None) -> tuple[float, list[int], list[int]]:
    """``tags`` of one text."""
    return next(tags(model, [text], entries))


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted, starts, ends: one row per row of ``docs``.

    Null and empty texts get the score of a text without matches. Without a model (no
    labelled rows of both kinds) every score is 0. Rows that
    repeat are scored alike; empty tables give no rows; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Entries(model) if model else None
        for batch in batches:
            found = list(tags(model, batch["text"].to_pylist(), entries))
            spans = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], spans), pa.array([f[2] for f in found], spans)], names=["doc_id", "score", "starts", "ends"]
            )

    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        scored = stage(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, starts array<long>, ends array<long>"), "scored")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "starts", "ends")


def without_toxic(docs: DataFrame, model: Model | None) -> DataFrame:
    """Rows of ``docs``, whole and in all columns, whose score stays below ``THRESHOLD``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = _Entries(model) if model else None
        at = names.index("text")
        for batch in batches:
            keep = [found[0] < THRESHOLD for found in tags(model, batch.column(at).to_pylist(), entries)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    names = docs.columns
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="1000"):
        return stage(docs.mapInArrow(run, docs.schema), "without_toxic")
