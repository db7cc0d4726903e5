"""Token counts with a public piece vocabulary, huge documents in overlapping chunks.

Short texts are encoded whole by the library. A huge one is cut into chunks that overlap. Each
chunk is encoded with the offsets of its tokens, and two neighbours are spliced at a token that
both have at the same place inside the overlap: left of it the first chunk's tokens count, from it
on the second's. That place is proven, not guessed: an encoding is the only sequence in which every
token and every two neighbouring tokens encode to themselves (merges of a region don't depend on what
lies beyond a seam that no merge crosses), and every two neighbours of the splice stand next to
each other in one of the two chunks. If no such token is found, the overlap is widened, at last
to the whole of the rest.

Null text counts as empty: no bytes, no tokens. Repeated rows give the same result each.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import text_of

CHUNK_CHARS = 32_768
OVERLAP = 256
LIMIT = 4096


class PieceCounter:
    """Counts tokens of a model that adds one leading space and changes nothing else."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0

    def pieces(self, data: bytes) -> list[tuple[int, int, int]]:
        """Begin and end (in bytes) and id of each token."""
        found = self.model.encode(data.decode("utf-8"), return_type="proto").pieces
        return [(p.begin, p.end, p.id) for p in found]

    @staticmethod
    def border(data: bytes, at: int) -> int:
        """The first place from ``at`` on that isn't inside a character."""
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(data))

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return len(self.model.encode(text))
        data = text.encode("utf-8")
        n, total, begin, skip = len(data), 0, 0, 0   # ``skip``: tokens of this chunk that belong to the one before
        stop = self.border(data, self.chunk)
        left = self.pieces(data[:stop])
        while stop < n:
            overlap = self.overlap
            while True:
                start = self.border(data, max(begin, stop - overlap))
                right_stop = self.border(data, stop + self.chunk)
                right = self.pieces(data[start:right_stop]) if start > begin else None
                if right is None:          # nothing in common: the chunk grows over both, at least twofold
                    stop = self.border(data, stop + max(self.chunk, stop - begin))
                    left = self.pieces(data[begin:stop])
                    break
                if at := self.meet(left, begin, right, start, skip):
                    total += at[0] - skip
                    left, begin, skip, stop = right, start, at[1], right_stop
                    break
                overlap *= 4
                self.widened += 1
        return total + len(left) - skip

    @staticmethod
    def meet(left, begin: int, right, start: int, skip: int) -> tuple[int, int] | None:
        """Positions in both chunks of a token they share, the last such one.

        The first token of ``right`` is never taken, as the model's leading space may be part of it,
        nor is the last of ``left``, which the cut may have shortened.
        """
        there = {(b + start, e + start, t): j for j, (b, e, t) in enumerate(right) if j and e > b}
        for i in range(len(left) - 2, max(skip, 1) - 1, -1):
            b, e, t = left[i]
            if b + begin < start:
                return None
            if (j := there.get((b + begin, e + begin, t))) is not None:
                return i, j
        return None


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` for every document."""
    def run(batches):
        own = counter(path)
        for batch in batches:
            counts = pa.array((own.count(t.as_py()) for t in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], names=["doc_id", "n_bytes", "n_tokens"])

    text = text_of()
    source = docs.select(F.col("doc_id").cast("bigint"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("_text"))
    counted = source.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
