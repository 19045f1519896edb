"""Edit distances of many pairs of texts at a time, by bit-parallel recurrences over arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Letters of a text that fit into one word of bits.
WORD = 63
#: Array cells that a search over whole texts holds at once.
CELLS = 1 << 23


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points, padded with 0 to the longest text, and lengths."""
    lengths = np.fromiter((len(t) for t in texts), np.int32, len(texts))
    width = int(lengths.max()) if len(texts) else 0
    flat = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(texts), width), lengths


def distance(a: str, b: str) -> int:
    """Levenshtein distance of two texts, for those longer than a word."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@dataclass
class Texts:
    """Texts with what the distance needs: code points, lengths and match masks by letter."""

    texts: list[str]
    codes: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Texts:
        return cls(texts, *code_points(texts))

    def masks(self, alphabet: np.ndarray) -> np.ndarray:
        """For each text and letter (0: any other) the positions that hold it, as bits."""
        out = np.zeros((len(self.texts), len(alphabet) + 1), np.uint64)
        at = letters(self.codes[:, :WORD], alphabet)
        rows = np.arange(len(self.texts))
        for j in range(at.shape[1]):
            np.bitwise_or.at(out, (rows, at[:, j]), np.uint64(1) << np.uint64(j))
        out[:, 0] = 0
        return out


def letters(codes: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Numbers of the letters in the sorted alphabet from 1; 0 for any other."""
    at = np.searchsorted(alphabet, codes)
    at[at == len(alphabet)] = 0
    return np.where(alphabet[at] == codes, at + 1, 0).astype(np.int16) if len(alphabet) else np.zeros(codes.shape, np.int16)


def pair_distances(left: Texts, masks: np.ndarray, i: np.ndarray, right: Texts, at: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Levenshtein distances of the pairs (left[i], right[j]); `left` gives the bit vectors, `at` has the letters of `right`."""
    m = left.lengths[i].astype(np.uint64)
    n = right.lengths[j]
    out = np.where(m == 0, n, m.astype(np.int32)).astype(np.int32)
    long = left.lengths[i] > WORD
    for x in np.flatnonzero(long):
        out[x] = distance(left.texts[i[x]], right.texts[j[x]])
    one = np.uint64(1)
    top = np.where(m > 0, one << (np.maximum(m, one) - one), 0).astype(np.uint64)
    pv = np.full(len(i), ~np.uint64(0))
    mv = np.zeros(len(i), np.uint64)
    score = out.copy()
    live = ~long & (m > 0)
    for step in range(int(n.max()) if len(n) else 0):
        eq = masks[i, at[j, step]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        on = live & (step < n)
        score += on & ((ph & top) != 0)
        score -= on & ((mh & top) != 0)
        ph = (ph << one) | one
        mh = mh << one
        pv = mh | ~(xv | ph)
        mv = ph & xv
    return np.where(live, score, out)


def _scores(pattern: str, codes: np.ndarray, anchored: bool) -> np.ndarray:
    """For each text and place the distance of `pattern` to the best part that ends there; `anchored` parts begin at 0."""
    m, one = len(pattern), np.uint64(1)
    n, width = codes.shape
    out = np.empty((width, n), np.int32)
    if m > WORD:
        steps = np.arange(m + 1, dtype=np.int32)
        row, p = np.tile(steps, (n, 1)), code_points([pattern])[0]
        for j in range(width):
            turned = row + 1
            turned[:, 0] = j + 1 if anchored else 0
            turned[:, 1:] = np.minimum(turned[:, 1:], row[:, :-1] + (p != codes[:, j : j + 1]))
            row = np.minimum.accumulate(turned - steps, axis=1) + steps
            out[j] = row[:, m]
        return out.T
    own = np.unique(code_points([pattern])[0])
    table = Texts.of([pattern]).masks(own)[0]
    at = letters(codes, own).T
    top = one << np.uint64(m - 1)
    pv, mv, score = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64), np.full(n, m, np.int32)
    for j in range(width):
        eq = table[at[j]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        score = score + ((ph & top) != 0) - ((mh & top) != 0)
        ph = (ph << one) | one if anchored else ph << one
        mh = mh << one
        pv = mh | ~(xv | ph)
        mv = ph & xv
        out[j] = score
    return out.T


def blocks(sizes: list[int]) -> Iterator[list[int]]:
    """Numbers of texts, alike in size, whose padded arrays stay small; a larger text stands alone."""
    block: list[int] = []
    for x in sorted(range(len(sizes)), key=sizes.__getitem__):
        if block and (len(block) + 1) * sizes[x] > CELLS:
            yield block
            block = []
        block.append(x)
    if block:
        yield block


def best_ends(pattern: str, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest distance of `pattern` to any part of each text; and for each such part its text and its end (exclusive).

    Without a letter that lowers the distance below the length of the pattern the part is empty and has no place.
    """
    m = len(pattern)
    best = np.full(len(texts), m, np.int32)
    who, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for block in blocks([len(t) for t in texts]) if m else ():
        own = [texts[x] for x in block]
        codes, lengths = code_points(own)
        if not codes.shape[1]:
            continue
        score = _scores(pattern, codes, anchored=False)
        score[np.arange(codes.shape[1]) >= lengths[:, None]] = m + 1
        low = np.minimum(score.min(1), m)
        best[block] = low
        row, place = np.nonzero((score == low[:, None]) & (low < m)[:, None])
        who.append(np.asarray(block)[row])
        ends.append(place + 1)
    which, where = np.concatenate(who), np.concatenate(ends)
    order = np.lexsort((where, which))
    return best, which[order], where[order]


def first_starts(pattern: str, texts: list[str], d: np.ndarray, who: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The smallest start of a part that ends at each place and is at the distance `d` of its text from `pattern`."""
    if not len(who):
        return np.zeros(0, np.int64)
    span = 2 * len(pattern) + 1
    before = [texts[w][max(0, e - span) : e][::-1] for w, e in zip(who, ends)]
    codes, lengths = code_points(before)
    score = _scores(pattern[::-1], codes, anchored=True)
    good = (score == d[who][:, None]) & (np.arange(codes.shape[1]) < lengths[:, None])
    longest = codes.shape[1] - good[:, ::-1].argmax(1)
    return ends - longest
