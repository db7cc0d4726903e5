"""A static range asymmetric numeral system for token ids, in numpy.

All coders share one frequency table. Ids are coded in blocks that stand alone: a block starts from
its own states and ends in its own words, so any block can be decoded without the others. Inside a
block ``LANES`` states take turns, so one numpy step codes that many ids. The directory in front
holds, for each block, where it begins (the checkpoint), how many ids it has and their crc32.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"RANS0001"
SCALE = 20               # the frequencies sum to 2 ** SCALE
LANES = 512
BLOCK = 131_072          # ids
LOW = np.uint64(1 << 32)
HEAD = struct.Struct("<8sBHIQI")   # magic, scale, lanes, blocks, ids, crc32 of the table
ENTRY = struct.Struct("<QIII")     # offset, ids, words, crc32 of the ids


class DamagedFile(ValueError):
    pass


def table_of(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2 ** SCALE`` in proportion to the counts, at least one for each id."""
    n = len(counts)
    spare = (1 << SCALE) - n
    if spare < 0:
        raise ValueError(f"{n} ids don't fit {1 << SCALE} slots")
    total = int(counts.sum())
    extra = [int(c) * spare // total for c in counts] if total else [spare // n] * n
    freq = np.array(extra, np.int64) + 1
    freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
    return freq.astype(np.uint32)


class Coder:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.base = np.concatenate([[0], np.cumsum(freq, dtype=np.uint64)[:-1]]).astype(np.uint64)
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    def block(self, ids: np.ndarray) -> tuple[bytes, int]:
        x, words = np.full(LANES, LOW), []
        freq, base = self.freq[ids], self.base[ids]
        for at in range((len(ids) - 1) // LANES * LANES, -1, -LANES):
            f, c = freq[at:at + LANES], base[at:at + LANES]
            state = x[:len(f)]
            high = state >= f << np.uint64(64 - SCALE)
            words.append(state[high].astype("<u4"))
            state = np.where(high, state >> np.uint64(32), state)
            q, r = np.divmod(state, f)
            x[:len(f)] = (q << np.uint64(SCALE)) + r + c
        flat = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        return x.astype("<u8").tobytes() + flat.tobytes(), len(flat)

    def encode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        parts, entries, at = [], [], 0
        for start in range(0, len(ids), BLOCK):
            some = ids[start:start + BLOCK]
            data, words = self.block(some)
            entries.append(ENTRY.pack(at, len(some), words, zlib.crc32(some.astype("<u4").tobytes())))
            parts.append(data)
            at += len(data)
        return b"".join([HEAD.pack(MAGIC, SCALE, LANES, len(parts), len(ids), self.crc), *entries, *parts])

    def unblock(self, data: memoryview, n: int, n_words: int) -> np.ndarray:
        x = np.frombuffer(data, "<u8", LANES).astype(np.uint64)
        words = np.frombuffer(data, "<u4", n_words, LANES * 8).astype(np.uint64)
        out, read, mask = np.empty(n, np.uint32), 0, np.uint64((1 << SCALE) - 1)
        for at in range(0, n, LANES):
            state = x[:min(LANES, n - at)]
            slot = state & mask
            ids = self.slots[slot]
            out[at:at + len(ids)] = ids
            state = self.freq[ids] * (state >> np.uint64(SCALE)) + slot - self.base[ids]
            low = np.flatnonzero(state < LOW)
            if len(low):
                state[low] = (state[low] << np.uint64(32)) | words[read:read + len(low)]
                read += len(low)
            x[:len(ids)] = state
        return out

    def decode(self, data: bytes, only: int | None = None) -> np.ndarray:
        """The ids of all blocks, or of one. Raises ``DamagedFile`` where a checksum fails."""
        view = memoryview(data)
        magic, scale, lanes, blocks, n, crc = HEAD.unpack_from(view)
        if (magic, scale, lanes, crc) != (MAGIC, SCALE, LANES, self.crc):
            raise DamagedFile("not written with this table")
        start, out = HEAD.size + ENTRY.size * blocks, []
        for k in range(blocks) if only is None else [only]:
            at, size, words, check = ENTRY.unpack_from(view, HEAD.size + ENTRY.size * k)
            try:
                ids = self.unblock(view[start + at:], size, words)
            except (ValueError, IndexError) as error:
                raise DamagedFile(f"block {k}") from error
            if zlib.crc32(ids.astype("<u4").tobytes()) != check:
                raise DamagedFile(f"block {k}")
            out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, np.uint32)
