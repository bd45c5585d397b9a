"""Pairs of one block of names, weighed side by side in NumPy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Counters that pairs of characters are folded into, pairs of names weighed at once, and characters that a word of bits holds.
COUNTERS, AT_ONCE, WORD = 512, 1 << 16, 64
#: Longer names aren't laid out side by side: their counters let every pair through, and Python weighs it.
LONG = 255
#: Where all names of two blocks meet: flags that pairs of characters are folded into, names that masks are held for, runs of names that begin alike.
FLAGS, STRIP, RUNS = 2048, 1024, 64
#: Names from this length on don't meet there, as bytes wouldn't do to count what they share.
MOST = 254


def indel(a: str, b: str) -> float:
    """Normalised insertion-deletion similarity, 0 to 100."""
    if not a and not b:
        return 100.0
    # Longest common subsequence, all of ``a`` at once as bits of one integer.
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        met = state & where.get(c, 0)
        state = (state + met) | (state - met)
    return 200.0 * (~state & full).bit_count() / (len(a) + len(b))


def _apart(both: np.ndarray, e: float) -> np.ndarray:
    """Most insertions and deletions by the sum of the joined lengths."""
    most = np.floor(both * e + 1e-9).astype(np.int64)
    return most - (most - both) % 2


def overlap(both: np.ndarray, e: float) -> np.ndarray:
    """``resolve._overlap`` by the sum of the joined lengths."""
    return (both + 2 - 3 * _apart(both, e)) // 2


def _letters(both: np.ndarray, e: float) -> np.ndarray:
    """How many characters are common at least, the space at the end among them."""
    return (both - _apart(both, e)) // 2 + 1


def _grid(lists: pa.ChunkedArray, fill: int) -> np.ndarray:
    """Lists of strings or flags as rows of numbers, filled up with ``fill``; equal strings have one number."""
    lists = lists.combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    flat = flat.cast(pa.int8()) if pa.types.is_boolean(flat.type) else pc.dictionary_encode(flat).indices
    out = np.full((len(sizes), max(int(sizes.max()), 1)), fill, np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat.to_numpy(zero_copy_only=False)
    return out


def _numbered(grid: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Numbers for what ``inside`` marks: one for each value and how often it came before in its row."""
    number = np.zeros(grid.shape, np.int64)
    for q in range(grid.shape[1] - 1):
        number[:, q + 1 :] += grid[:, q + 1 :] == grid[:, q : q + 1]
    return np.unique((grid * grid.shape[1] + number)[inside], return_inverse=True)[1]


class _Block:
    """The rows of a group: their characters, counters, tokens and listed pairs of characters."""

    def __init__(self, table: pa.Table) -> None:
        self.keys = table["k"].to_pylist()
        self.at, self.n, self.size = (table[c].to_numpy().astype(np.int64) for c in ("at", "n", "size"))
        self.by_gram, self.all = pc.equal(table["kind"], "g").to_numpy(), table["all"].to_numpy()
        self.tokens, self.rare, self.picked = _grid(table["tokens"], -1), _grid(table["rare"], -1), _grid(table["picked"], 0) > 0
        self.count, self.token_at = (self.tokens >= 0).sum(1), np.ascontiguousarray(self.tokens.T)
        # Every token is followed by a space, the first has one ahead.
        self.joined = [" ".join(x) + " " for x in table["tokens"].to_pylist()]
        long = self.size > LONG
        wide = np.array([" " if odd else x for x, odd in zip(self.joined, long.tolist(), strict=True)])
        chars = wide.view(np.uint32).reshape(len(wide), -1)
        inside = (np.arange(chars.shape[1]) <= self.size[:, None]) & ~long[:, None]
        self.names, codes = np.unique(chars, return_inverse=True)
        self.codes = codes = codes.reshape(chars.shape)
        space = (chars == 32) & inside
        self.token_of = np.cumsum(space, axis=1) - space
        self.lengths = np.zeros(self.tokens.shape, np.int64)
        np.add.at(self.lengths, (np.nonzero(inside & ~space)[0], self.token_of[inside & ~space]), 1)
        for k in np.flatnonzero(long).tolist():
            own = [len(t) for t in self.joined[k].split(" ")[:-1]]
            self.lengths[k, : len(own)] = own
        ahead = np.concatenate((np.full((len(wide), 1), np.searchsorted(self.names, 32)), codes[:, :-1]), axis=1)
        # The rows and numbers of all pairs of characters; a repeated pair has numbers of its own.
        self.inside, self.grams = inside, ahead * len(self.names) + codes
        self.holder, self.gram = np.nonzero(inside)[0], _numbered(self.grams, inside)
        self.long, self.wide = long, wide
        self.fits = self.size < WORD
        # Words of half the size do if no name that fits needs more.
        self.word = np.uint32 if self.size[self.fits].max(initial=0) < 32 else np.uint64
        self.width = min(chars.shape[1], np.iinfo(self.word).bits)
        self.bits = (self.word(1) << np.arange(self.width, dtype=self.word)) * (inside & self.fits[:, None])[:, : self.width]
        self.covers = np.zeros(self.tokens.shape, self.word)  # the characters of a token and the space after it
        rows = np.arange(len(wide))
        for p in range(self.width):
            own = np.minimum(self.token_of[:, p], self.tokens.shape[1] - 1)
            self.covers[rows, own] |= self.bits[:, p]
        self.whole = self.bits.sum(1, dtype=self.word)
        self.code_at = np.ascontiguousarray(codes[:, : self.width].T)

    @cached_property
    def counters(self) -> np.ndarray:
        """Folded counters only ever count too much."""
        out = np.bincount(self.holder * COUNTERS + self.gram % COUNTERS, minlength=len(self.size) * COUNTERS).reshape(-1, COUNTERS).astype(np.float32)
        out[self.long] = self.size[self.long, None] + 1
        return out

    def masks(self, start: int, stop: int) -> np.ndarray:
        """For each of the rows and characters, the places that hold it."""
        out, rows = np.zeros((stop - start, len(self.names)), self.word), np.arange(stop - start)
        for p in range(self.width):
            out[rows, self.codes[start:stop, p]] |= self.bits[start:stop, p]
        return out


def _meeting(block: _Block, table: pa.Table, e: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that share an element and, if it is a pair of characters, may share enough of them."""
    own, i, j = table["own"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    element = pc.dictionary_encode(table["element"].combine_chunks()).indices.to_numpy() * 2 + block.by_gram
    order = np.argsort(element, kind="stable")
    need = overlap(np.arange(2 * int(block.size.max()) + 1), e).astype(np.float32)
    for run in np.split(order, np.flatnonzero(np.diff(element[order])) + 1):
        left, right = (run, run) if i == j else (run[own[run] == i], run[own[run] == j])
        if not len(left) or not len(right):
            continue
        if block.by_gram[run[0]]:
            hit = block.counters[left] @ block.counters[right].T >= need[block.size[left][:, None] + block.size[right]]
        else:
            flag = block.picked[left, block.at[left]], block.picked[right, block.at[right]]
            hit = flag[0][:, None] | flag[1]
        x, y = np.nonzero(np.triu(hit, 1) if i == j else hit)
        yield left[x], right[y]


def _first(block: _Block, x: np.ndarray, y: np.ndarray, e: float, ratio: float) -> np.ndarray:
    """Which pairs are within the guard and have their first meeting here: of tokens that either picked, or else of listed pairs of characters."""
    ok = np.minimum(block.n[x], block.n[y]) >= ratio * np.maximum(block.n[x], block.n[y])
    by_gram, sx, sy = block.by_gram[x], block.size[x], block.size[y]
    # By the first shared pair's place, what is left on either side must suffice.
    # Pairs that meet where all do don't meet by pairs of characters.
    ok &= ~by_gram | ~(block.all[x] & block.all[y]) & (1 + np.minimum(sx - block.at[x], sy - block.at[y]) >= overlap(sx + sy, e))
    x, y, by_gram, back = x[ok], y[ok], by_gram[ok], np.flatnonzero(ok)
    mine, theirs, flags = block.tokens[x], block.tokens[y], block.picked[y]
    first = np.full(len(x), -1)
    for p in range(mine.shape[1] - 1, -1, -1):
        same = (theirs == mine[:, p : p + 1]) & (mine[:, p : p + 1] >= 0)
        first[(same & (flags | block.picked[x, p][:, None])).any(1)] = p
    keep = np.where(by_gram, first < 0, first == block.at[x])
    x, y, by_gram, back = x[keep], y[keep], by_gram[keep], back[keep]
    seen, at = np.zeros(len(x), bool), block.at[x]
    theirs = np.where(np.arange(block.rare.shape[1]) < block.at[y][:, None], block.rare[y], -2)
    for p in range(int(at.max(initial=0)) if by_gram.any() else 0):
        seen |= (theirs == block.rare[x, min(p, block.rare.shape[1] - 1)][:, None]).any(1) & (p < at)
    ok[:] = False
    ok[back[~(seen & by_gram)]] = True
    return ok


def _common(block: _Block, masks: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, kept: np.ndarray, off: np.ndarray, begin: int) -> np.ndarray:
    """Longest common subsequences from place ``begin`` on, all of one side at once as bits of a word.

    ``kept`` has the places of ``x`` that count, ``off`` those of ``y`` that don't; ``at`` are the rows of ``masks``.
    """
    state, one = np.full(len(x), np.iinfo(block.word).max, block.word), block.word(1)
    flat, row, some = masks.ravel(), at * masks.shape[1], bool((off >> block.word(begin)).any())
    for p in range(begin, min(int(block.size[y].max()) + 1, block.width)):
        met = flat.take(row + block.code_at[p].take(y))
        met &= kept
        if some:
            met &= ((off >> block.word(p)) & one) - one
        met &= state
        state = (state + met) | (state - met)
    return np.bitwise_count(~state & kept).astype(np.int64)


def _scores(block: _Block, masks: np.ndarray, start: int, x: np.ndarray, y: np.ndarray, alike: int = 0) -> np.ndarray:
    """Similarity of the token sets, 0 to 100; ``masks`` begin with row ``start``, and all names with the same ``alike`` characters."""
    mine, theirs = ([t.take(rows) for t in block.token_at] for rows in (x, y))
    left, right = ([np.zeros(len(x), bool) for _ in block.token_at] for _ in "xy")
    for p, a in enumerate(mine):
        for q, b in enumerate(theirs):
            same = a == b
            if p and q:
                same &= a >= 0
            left[p] |= same
            right[q] |= same
    shared, length = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    kept, off = block.whole[x], np.zeros(len(x), block.word)
    zero = block.word(0)
    for p in range(len(mine)):
        if left[p].any():
            shared += left[p]
            length += np.where(left[p], block.lengths[x, p], 0)
            kept &= ~np.where(left[p], block.covers[x, p], zero)
            off |= np.where(right[p], block.covers[y, p], zero)
        elif right[p].any():
            off |= np.where(right[p], block.covers[y, p], zero)
    length += np.maximum(shared - 1, 0)
    sx, sy = block.size[x], block.size[y]
    out = np.where(shared > 0, 200.0 * length / (length + np.minimum(sx, sy)), 0.0)
    inside = (shared == block.count[x]) | (shared == block.count[y])
    out[inside] = 100.0
    fit = ~inside & block.fits[x] & block.fits[y]
    # What both begin with is common; where the token that it ends in is kept by both, it needn't be looked for.
    ahead = block.joined[x[0]][:alike]
    token, since = ahead.count(" "), ahead.rfind(" ") + 1
    skip = ~(left[token] | right[token]) if token < len(left) and since < alike else np.zeros(len(x), bool)
    for some, begin, sure in ((fit & skip, alike, alike - since), (fit & ~skip, since, 0)):
        rows = np.flatnonzero(some)
        if len(rows):
            own = (kept[rows] >> block.word(begin)) << block.word(begin)
            lcs = _common(block, masks, x[rows] - start, x[rows], y[rows], own, off[rows], begin) + sure - 1
            lcs += np.where(shared[rows] > 0, length[rows] + 1, 0)
            out[rows] = np.maximum(out[rows], 200.0 * lcs / (sx[rows] + sy[rows]))
    for k in np.flatnonzero(~inside & ~fit).tolist():
        sides = [block.joined[r[k]].split(" ")[:-1] for r in (x, y)]
        both = [t for t in sides[0] if t in sides[1]]
        out[k] = max(out[k], indel(*(" ".join(both + [t for t in s if t not in both]) for s in sides)))
    return out


def _gathered(pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, some ``AT_ONCE`` at once."""
    held, many = [], 0
    for x, y in pairs:
        for k in range(0, len(x), AT_ONCE):
            held.append((x[k : k + AT_ONCE], y[k : k + AT_ONCE]))
            many += len(held[-1][0])
            if many >= AT_ONCE:
                yield tuple(map(np.concatenate, zip(*held, strict=True)))
                held, many = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _alike(words: list[str]) -> int:
    """How many characters at the beginning the first and the last have in common."""
    a, b = words[0], words[-1]
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


class _Flags:
    """What names hold: for each element a row of flags over the names on the right (``held`` there, if not what they hold themselves)."""

    def __init__(self, of: np.ndarray, element: np.ndarray, right: np.ndarray, size: np.ndarray, need: np.ndarray, held: Iterator[tuple[np.ndarray, np.ndarray]] | None = None) -> None:
        back = np.full(len(size), -1)
        back[right] = np.arange(len(right))
        # Frequent elements have flags of their own, the others share some; too many are counted then, never too few.
        often = np.bincount(element)
        flag, own = np.empty(len(often), np.int64), min(len(often), FLAGS // 2)
        flag[np.argsort(-often, kind="stable")] = np.concatenate((np.arange(own), own + np.arange(len(often) - own) % (FLAGS // 2)))
        self.rows = np.zeros((int(flag.max(initial=0)) + 1, len(right)), np.uint8)
        for by, what in [(of, element)] if held is None else held:
            inside = (back[by] >= 0) & (what < len(flag))
            self.rows[flag[what[inside]], back[by[inside]]] = 1
        element = flag[element]
        # What all on the right hold is counted once; the others' rows are added up.
        everyone = self.rows.all(axis=1)[element]
        self.sure = np.bincount(of, everyone, len(size)).astype(np.int64).tolist()
        of, element = of[~everyone], element[~everyone]
        self.own = element[np.argsort(of, kind="stable")]
        self.edges = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(size))))).tolist()
        self.size, self.theirs, self.need, self.least = size.tolist(), size[right], need, {}

    def met(self, x: int) -> np.ndarray:
        """Which names on the right hold enough of what ``x`` holds."""
        key = self.size[x], self.sure[x]
        if key not in self.least:
            least = self.need[key[0]][self.theirs]
            self.least[key] = np.where(least < 255, np.maximum(least - key[1], 0), 255).astype(np.uint8)
        return np.add.reduce(self.rows.take(self.own[self.edges[x] : self.edges[x + 1]], axis=0), axis=0, dtype=np.uint8) >= self.least[key]


class _All:
    """Where the names of two blocks, sorted, all meet: by flags for their characters, pairs of them and places."""

    def __init__(self, block: _Block, own: np.ndarray, i: int, j: int, e: float, ratio: float) -> None:
        self.block, self.same, self.ratio = block, i == j, ratio
        self.left, self.right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        size = np.arange(int(block.size.max()) + 1)
        both, more = size[:, None] + size, size - size[:, None]
        near = np.abs(more) <= both * e + 1e-9
        # A byte counts what a name holds; 255 is never reached.
        letters, grams = (np.where(near, np.maximum(f(both, e), 0), 255) for f in (_letters, overlap))
        # A character that is common stands so many places before or after at most.
        there = np.isin(size, block.size)
        reach = np.where(near & there[:, None], _apart(both, e) + more, 0).max(0) // 2, np.where(near & there[:, None], _apart(both, e) - more, 0).max(0) // 2
        holder, place = np.nonzero(block.inside)
        code = block.codes[block.inside]
        number = np.full(block.codes.shape[1] * len(block.names), 1 << 30)
        element = np.unique(place * len(block.names) + code, return_inverse=True)
        number[element[0]] = np.arange(len(element[0]))

        def held() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            before, after = (r[block.size[holder]] for r in reach)
            for k in range(-int(before.max(initial=0)), int(after.max(initial=0)) + 1):
                ok = (-before <= k) & (k <= after) & (place + k >= 0) & (place + k < block.codes.shape[1])
                yield holder[ok], number[(place[ok] + k) * len(block.names) + code[ok]]

        self.flags = [
            _Flags(holder, _numbered(block.codes, block.inside), self.right, block.size, letters),
            _Flags(holder, element[1], self.right, block.size, letters, held()),
            _Flags(holder, block.gram, self.right, block.size, grams),
        ]
        heads = np.unique(block.token_at[0], return_inverse=True)[1]
        run = np.concatenate(([0], np.cumsum(np.diff(heads) != 0)))
        if run[-1] >= RUNS:
            run = np.arange(len(own)) * RUNS // len(own)
        self.run, edges = run, np.unique(run, return_index=True)[1].tolist() + [len(own)]
        words = [(min(w), max(w)) for w in (block.wide[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True))]
        within = [_alike(w) for w in words]
        self.begin = np.array([[min(p, q, _alike((v[0], w[0]))) for w, q in zip(words, within, strict=True)] for v, p in zip(words, within, strict=True)])
        # Tokens that are dealt and thus meet elsewhere.
        at = block.tokens[block.tokens >= 0]
        self.dealt = (np.bincount(at) > 1) & (np.bincount(at, block.picked[block.tokens >= 0], len(np.bincount(at))) > 0)

    def _met(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for x in rows.tolist():
            letters, places, grams = (f.met(x) for f in self.flags)
            letters &= places
            letters &= grams
            y = self.right[np.flatnonzero(letters)]
            y = y[np.searchsorted(y, x, "right") :] if self.same else y
            yield np.full(len(y), x), y

    def pairs(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Pairs that may score, with the number of characters that all of their names begin with: those of one run apart from others."""
        block, n = self.block, self.block.n
        near = n.min() >= self.ratio * n.max()
        held, many = [], 0
        for part in np.split(rows, np.flatnonzero(np.diff(self.run[rows])) + 1):
            for x, y in _gathered(self._met(part)):
                if not near:
                    ok = np.minimum(n[x], n[y]) >= self.ratio * np.maximum(n[x], n[y])
                    x, y = x[ok], y[ok]
                if self.dealt.any():
                    ok = np.ones(len(x), bool)
                    for p, a in enumerate(block.token_at):
                        for q, b in enumerate(block.token_at):
                            ok &= ~((a[x] == b[y]) & (a[x] >= 0) & (block.picked[x, p] | block.picked[y, q]))
                    x, y = x[ok], y[ok]
                one = self.run[x] == self.run[y]
                if one.any():
                    yield self._ready(x[one], y[one])
                held.append((x[~one], y[~one]))
                many += len(held[-1][0])
                if many >= AT_ONCE:
                    yield self._ready(*map(np.concatenate, zip(*held, strict=True)))
                    held, many = [], 0
        if many:
            yield self._ready(*map(np.concatenate, zip(*held, strict=True)))

    def _ready(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        run = self.run[x]
        return x, y, int(min(self.begin[run, self.run[y]].min(), self.begin[run[0], run].min()))


def pairs_of_block(table: pa.Table, score: int, e: float, ratio: float) -> Iterator[pa.RecordBatch]:
    """(a, b, score), a < b, of the pairs of a group that have their first meeting in it."""
    everyone = table["kind"][0].as_py() == "a"
    if everyone:
        table = table.append_column("joined", pc.binary_join(table["tokens"].combine_chunks(), " ")).sort_by("joined")
    block = _Block(table)
    ranks = {k: r for r, k in enumerate(sorted(set(block.keys)))}
    rank = np.array([ranks[k] for k in block.keys])
    keys = table["k"].combine_chunks()

    def weighed(masks: np.ndarray, start: int, x: np.ndarray, y: np.ndarray, alike: int = 0) -> Iterator[pa.RecordBatch]:
        if not len(x):
            return
        points = np.floor(_scores(block, masks, start, x, y, alike) + 0.5).astype(np.int32)
        ok = points >= score
        x, y, points = x[ok], y[ok], points[ok]
        swap = rank[x] > rank[y]
        if len(x):
            yield pa.record_batch({"a": keys.take(pa.array(np.where(swap, y, x))), "b": keys.take(pa.array(np.where(swap, x, y))), "score": points})

    if not everyone:
        masks = block.masks(0, len(block.size))
        for x, y in _gathered(_meeting(block, table, e)):
            ok = _first(block, x, y, e, ratio)
            yield from weighed(masks, 0, x[ok], y[ok])
        return
    own, i, j = table["own"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    if i != j and (own == own[0]).all():
        return
    met = _All(block, own, i, j, e, ratio)
    for start in range(0, len(own), STRIP):
        stop = min(start + STRIP, len(own))
        masks = block.masks(start, stop)
        for x, y, alike in met.pairs(met.left[np.searchsorted(met.left, start) : np.searchsorted(met.left, stop)]):
            yield from weighed(masks, start, x, y, alike)
