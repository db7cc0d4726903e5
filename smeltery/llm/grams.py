"""n-gram indicators of texts as hashed numbers, for many texts at once in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BITS = 16                  # size of the feature space
BYTE_ORDERS = (2, 3)       # n-grams of bytes
SHAPE_ORDERS = (3, 5)      # n-grams of kinds of signs, runs of one kind taken as one
WORD_ORDERS = (1, 2)       # n-grams of words
PIECE = 1 << 18            # bytes taken at a time
TEXTS = 128                # texts taken at a time
OVERLAP = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
MIX32 = np.uint32(0x9E3779B1)

KIND = np.arange(256, dtype=np.uint8)
KIND[48:58], KIND[65:91], KIND[97:123], KIND[128:] = 48, 65, 97, 97
BLANK = np.zeros(256, bool)
BLANK[[32, *range(9, 14)]] = True
KIND[BLANK] = 32
POWERS = np.cumprod(np.full(PIECE + OVERLAP, 0x100000001B3, np.uint64), dtype=np.uint64)


def slots(codes: np.ndarray, salt: int) -> np.ndarray:
    h = (codes + np.uint64(salt)) * MIX
    h ^= h >> np.uint64(29)
    return (h * MIX >> np.uint64(64 - BITS)).astype(np.uint32)


def byte_slots(x: np.ndarray, order: int, salt: int) -> np.ndarray:
    """The slot of every ``order`` neighbours, at most five."""
    n = max(len(x) - order + 1, 0)
    kind, mix, bits = (np.uint32, MIX32, 32) if order < 4 else (np.uint64, MIX, 64)
    code = x[:n].astype(kind)
    for k in range(1, order):
        code |= x[k:n + k].astype(kind) << kind(8 * k)
    code += kind(salt)
    code *= mix
    code ^= code >> kind(bits // 2)
    code *= mix
    return (code >> kind(bits - BITS)).astype(np.uint32)


def words_in(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every word begins, and a hash of it: its bytes weighed by their places in it."""
    inside = ~BLANK[x]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(first, sizes)
    value = (x[inside].astype(np.uint64) + np.uint64(1)) * POWERS[place]
    return starts, np.add.reduceat(value, first)


class Indicators:
    """The distinct features of whole texts."""

    def __init__(self):
        self.seen = np.zeros(TEXTS << BITS, bool)

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The features of each text, ascending."""
        held: list[bytes] = []
        size = 0
        for text in texts:
            data = b"\x02 " + text.encode() + b" \x03 "
            if held and (size + len(data) > PIECE or len(held) == TEXTS):
                yield from self.together(held)
                held, size = [], 0
            held.append(data)
            size += len(data)
        if held:
            yield from self.together(held)

    def together(self, rows: list[bytes]) -> list[np.ndarray]:
        """A text too long for a piece comes alone, in overlapping pieces, so that no n-gram is lost at their
        borders; a word that a border cuts gives features of its parts as well."""
        x = np.frombuffer(b"".join(rows), np.uint8)
        row = np.repeat(np.arange(len(rows), dtype=np.uint32), [len(r) for r in rows])
        for at in range(0, len(x), PIECE):
            self.mark(x[at:at + PIECE + OVERLAP], row[at:at + PIECE + OVERLAP])
        found = np.flatnonzero(self.seen[:len(rows) << BITS])
        self.seen[found] = False
        cut = np.searchsorted(found, np.arange(1, len(rows)) << BITS)
        return np.split((found & (1 << BITS) - 1).astype(np.uint32), cut)

    def note(self, slot: np.ndarray, row: np.ndarray, order: int) -> None:
        """Marks n-grams that lie in one text; ``row`` is that of each unit."""
        start = row[:len(slot)]
        inside = start == row[order - 1:len(slot) + order - 1]
        self.seen[((start << np.uint32(BITS)) | slot)[inside]] = True

    def mark(self, x: np.ndarray, row: np.ndarray) -> None:
        for n in BYTE_ORDERS:
            self.note(byte_slots(x, n, n << 24), row, n)
        kinds = KIND[x]
        turn = np.flatnonzero(np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (row[1:] != row[:-1])]))
        for n in SHAPE_ORDERS:
            self.note(byte_slots(kinds[turn], n, (16 + n) << 24), row[turn], n)
        starts, words = words_in(x)
        many, of = words, row[starts]
        for n in WORD_ORDERS:
            if n > 1:
                many = many[:-1] * np.uint64(31) + words[n - 1:]
            self.note(slots(many, n), of, n)
        # A word two, three and five times in a row.
        run = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        for n, step in ((1, 0), (2, 1), (4, 2)):
            if step:
                run = run[:-step] & run[step:]
            again = np.unique(of[:len(run)][run])
            self.seen[(again << np.uint32(BITS)) | slots(np.array([n], np.uint64), 48)] = True
