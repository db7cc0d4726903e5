"""Fragments of two tokenizations of one byte string, and how neighbours compose.

A fragment knows the tokens of both tokenizers over a stretch of bytes; the two stretches needn't begin or end at the
same byte. Where a token of either ends at the same byte, the stretch is cut. Tokens up to the first cut are the open
prefix, those behind the last one the open suffix, and all between are closed groups, which no neighbour can change.
Composing two fragments joins the left one's open end with the right one's open start, finds the cuts in there, and
closes what lies between cuts. This is associative, with the fragment of no tokens as its unit, so fragments of one
text may be composed in any tree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

DIGITS = 5   # of the largest id that can be written
A_END, B_END, INSIDE = b"|"[0], b";"[0], b","[0]


@dataclass
class Tokens:
    """Tokens in order: ids and the byte where each ends, for either tokenizer."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def between(self, low: int | None, high: int | None) -> "Tokens":
        """Those that end after ``low`` and not after ``high``."""
        def cut(ids, ends):
            i = 0 if low is None else np.searchsorted(ends, low, "right")
            j = len(ends) if high is None else np.searchsorted(ends, high, "right")
            return ids[i:j], ends[i:j]
        return Tokens(*cut(self.a, self.a_end), *cut(self.b, self.b_end))

    def cuts(self) -> np.ndarray:
        return np.intersect1d(self.a_end, self.b_end, assume_unique=True)

    def __add__(self, other: "Tokens") -> "Tokens":
        return Tokens(*[np.concatenate([x, y]) for x, y in zip(self.parts(), other.parts())])

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end


def no_tokens() -> Tokens:
    return Tokens(*[np.zeros(0, np.int64) for _ in range(4)])


@dataclass
class Fragment:
    """``first`` and ``last`` are its cuts; without any, ``prefix`` holds all tokens."""

    prefix: Tokens
    suffix: Tokens = field(default_factory=no_tokens)
    first: int | None = None
    last: int | None = None


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """The open ends of a stretch, and the tokens of its closed groups."""
    cuts = tokens.cuts()
    if not len(cuts):
        return Fragment(tokens), no_tokens()
    first, last = int(cuts[0]), int(cuts[-1])
    return Fragment(tokens.between(None, first), tokens.between(last, None), first, last), tokens.between(first, last)


def compose(left: Fragment, right: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of both, and the tokens of the groups that this closes."""
    met = (left.prefix if left.first is None else left.suffix) + right.prefix
    cuts = met.cuts()
    if not len(cuts):
        return (Fragment(met) if left.first is None else Fragment(left.prefix, met, left.first, left.last)), no_tokens()
    low, high = int(cuts[0]), int(cuts[-1])
    suffix = met.between(high, None) if right.first is None else right.suffix
    last = high if right.first is None else right.last
    if left.first is None:
        return Fragment(met.between(None, low), suffix, low, last), met.between(low, high)
    return Fragment(left.prefix, suffix, left.first, last), met.between(None, high)


def written(tokens: Tokens) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Closed groups as text ``a1,a2|b1;a3|b2;``; the bytes of this text up to each group's end; and the ids of the last
    token of either tokenizer in each group, the one linked pair that it holds."""
    cuts = tokens.cuts()
    of_a, of_b = np.searchsorted(cuts, tokens.a_end), np.searchsorted(cuts, tokens.b_end)
    n_a, n_b, n = len(of_a), len(of_b), len(cuts)
    last_a, last_b = np.searchsorted(of_a, np.arange(n), "right") - 1, np.searchsorted(of_b, np.arange(n), "right") - 1
    # A group's tokens of A come before those of B.
    place_a = np.arange(n_a) + np.searchsorted(of_b, of_a)
    place_b = np.arange(n_b) + np.searchsorted(of_a, of_b, "right")
    ids = np.empty(n_a + n_b, np.int32)
    ids[place_a], ids[place_b] = tokens.a, tokens.b
    after = np.full(n_a + n_b, INSIDE, np.uint8)
    after[place_a[last_a]], after[place_b[last_b]] = A_END, B_END
    size = np.ones(n_a + n_b, np.int64)
    for k in range(1, DIGITS):
        size += ids >= 10 ** k
    stop = np.cumsum(size + 1)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    out[stop - 1] = after
    at, rest = stop - 2, ids
    for k in range(DIGITS):
        out[at] = 48 + rest % 10
        rest = rest // 10
        more = rest > 0
        if not more.any():
            break
        if not more.all():
            at, rest = at[more], rest[more]
        at = at - 1
    return out.tobytes(), stop[place_b[last_b]] if n else stop[:0], tokens.a[last_a], tokens.b[last_b]
