"""Byte-pair encoding of words by speculation and verification, in numpy batches.

A word is cut greedily into the longest known tokens. That guess is right exactly when every token
encodes to itself and no merge ever crosses a seam. The second half is decided for all adjacent
pairs of a batch at once: the pair is wound back, last merge first, and at each step the merge
across the seam (if there is one) must come later than the merge that used up its parts. The
restriction of the merge order to two neighbours doesn't depend on the rest of the word, so pairs
decide for whole words. Only words with a bad token or seam are merged step by step.
"""

from __future__ import annotations

import heapq
import json

import numpy as np

FAR = np.int64(1) << 40
SHORT = 24  # letters; such words are merged side by side


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], spare = chr(spare), spare + 1
    return [letters[b] for b in range(256)]


class Merges:
    """A vocabulary with ranked merges. ``end`` is glued to the last letter of a word."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.size = max(self.ids.values()) + 1
        self.tokens = [""] * self.size
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.letters = byte_letters()
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.arange(self.size, dtype=np.int64)
        self.right = np.arange(self.size, dtype=np.int64)
        keys = np.empty(len(model["merges"]), np.int64)
        self.made = np.empty(len(model["merges"]), np.int64)
        for rank, (a, b) in enumerate(model["merges"]):
            a, b, c = self.ids[a], self.ids[b], self.ids[a + b]
            keys[rank] = a * self.size + b
            self.made[rank] = c
            self.pairs[a, b] = (rank, c)
            if self.rank[c] < 0:
                self.rank[c], self.left[c], self.right[c] = rank, a, b
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        # Longest match needs the token with and without the end mark, in letters of bytes.
        self.longest = max(len(t) for t in self.ids)
        self.sound = np.zeros(self.size, np.int8)  # 0 not asked, 1 encodes to itself, -1 doesn't
        self.merged_words = 0

    def cross_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], FAR)

    def seams_hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens whether no merge crosses between them."""
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(a), FAR)
        while len(live):
            broken = self.cross_rank(a, b) < limit
            good[live[broken]] = False
            ra, rb = self.rank[a], self.rank[b]
            keep = ~broken & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[keep], a[keep], b[keep], ra[keep], rb[keep]
            # The later merge is undone first; of two equal ones the right one came later.
            first = ra > rb
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def tokens_sound(self, ids: np.ndarray) -> np.ndarray:
        for t in np.unique(ids[self.sound[ids] == 0]).tolist():
            whole = self.tokens[t]
            closed = bool(self.end) and whole.endswith(self.end) and len(whole) > len(self.end)
            body = whole[:-len(self.end)] if closed else whole
            self.sound[t] = 1 if self.exact(self.start(body, closed)) == [t] else -1
        return self.sound[ids] > 0

    def start(self, letters: str, closed: bool) -> list[int]:
        if not closed:
            return [self.ids[c] for c in letters]
        return [*(self.ids[c] for c in letters[:-1]), self.ids[letters[-1] + self.end]]

    def guess(self, letters: str) -> list[int]:
        """Longest known tokens from the left; the end mark only fits at the end."""
        ids, out, at, n = self.ids, [], 0, len(letters)
        while at < n:
            for stop in range(min(n, at + self.longest), at, -1):
                token = ids.get(letters[at:stop] + self.end if stop == n else letters[at:stop])
                if token is not None:
                    out.append(token)
                    at = stop
                    break
        return out

    def exact(self, ids: list[int]) -> list[int]:
        """Merge the lowest rank first, leftmost among equals, with a heap over a linked list."""
        n = len(ids)
        if n < 2:
            return ids
        ids, after, before = list(ids), [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(p[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (p := self.pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.pairs[a, b][1], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if p := self.pairs.get((ids[i], ids[k])):
                    heapq.heappush(heap, (p[0], i, ids[i], ids[k]))
            h = before[i]
            if h >= 0 and (p := self.pairs.get((ids[h], ids[i]))):
                heapq.heappush(heap, (p[0], h, ids[h], ids[i]))
        return [t for t in ids if t >= 0]

    def exact_many(self, rows: list[list[int]]) -> list[list[int]]:
        """``exact`` for many short words side by side: one merge of each word per step."""
        n, width = len(rows), max(map(len, rows))
        ids = np.full((n, width + 1), -1, np.int64)
        for i, row in enumerate(rows):
            ids[i, :len(row)] = row
        rank = self.cross_rank(ids[:, :-1], ids[:, 1:])
        rank[(ids[:, :-1] < 0) | (ids[:, 1:] < 0)] = FAR
        out: list[list[int]] = [[]] * n
        who = np.arange(n)
        while True:
            line = np.arange(len(who))
            at = rank.argmin(1)
            best = rank[line, at]
            done = best >= FAR
            for i, row in zip(who[done].tolist(), ids[done].tolist()):
                out[i] = [t for t in row if t >= 0]
            if done.all():
                return out
            going = ~done
            ids, rank, who, at, best, line = ids[going], rank[going], who[going], at[going], best[going], line[:going.sum()]
            ids[line, at] = self.made[best]
            cols = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, cols + (cols > at[:, None]), 1)
            rank = np.take_along_axis(rank, cols[:-1] + (cols[:-1] > at[:, None]), 1)
            for side in (at - 1, at):
                ok = np.flatnonzero((side >= 0) & (side < rank.shape[1]))
                a, b = ids[ok, side[ok]], ids[ok, side[ok] + 1]
                rank[ok, side[ok]] = np.where(b >= 0, self.cross_rank(a, np.maximum(b, 0)), FAR)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Words are texts before the byte letters."""
        letters = [w if w.isascii() and w.isprintable() and " " not in w else
                   "".join([self.letters[b] for b in w.encode("utf-8", "surrogatepass")]) for w in words]
        found = [self.guess(x) for x in letters]
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.array([t for x in found for t in x], np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        bad = np.zeros(len(words), bool)
        bad[word[~self.tokens_sound(flat)]] = True
        inner = np.flatnonzero(word[1:] == word[:-1])
        seams, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        held = self.seams_hold(seams // self.size, seams % self.size)
        bad[word[inner[~held[back]]]] = True
        again = np.flatnonzero(bad).tolist()
        self.merged_words += len(again)
        short = [i for i in again if len(letters[i]) <= SHORT]
        for at in range(0, len(short), 4096):
            some = short[at:at + 4096]
            for i, ids in zip(some, self.exact_many([self.start(letters[i], bool(self.end)) for i in some])):
                found[i] = ids
        for i in again:
            if len(letters[i]) > SHORT:
                found[i] = self.exact(self.start(letters[i], bool(self.end)))
        return found
