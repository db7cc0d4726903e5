"""Token ids of documents in entropy-coded files, and their reader.

Documents are encoded to the ids of the tokenizers library, an end id is appended, and all are put
in order of id by a range shuffle. Each task writes segments
of whole documents: their ids in the format of ``rans``, with document ids and lengths beside them.
Segments are rows of Parquet files, so they live in any store that Spark reaches and are committed
as Spark commits files; the frequency table and the manifest lie beside them. The table counts all
tokens of the corpus; its size is that of the vocabulary. The reader needs only the folder.

Null text counts as empty (the end id alone). Null ids come first, equal ids in order of a hash of
the text. Repeated rows are written each. An empty table gives an empty folder and no rows.
"""

from __future__ import annotations

import os
import re
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from smeltery.llm.common import text_of
from smeltery.llm.letters import LetterGuard
from smeltery.llm.merges import byte_letters
from smeltery.llm.rans import BLOCK, Coder, table_of
from smeltery.session import checkpoint_root, stage

# The word pattern of the vocabulary file.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLANKS = re.compile(r"\s{1000}")
END_ID = 0


class ByteCoder:
    """Ids of texts as the tokenizers library gives them.

    The merges run in tiktoken, on the library's own vocabulary file, at twice the speed. Texts that
    hold a special string, a very long run of blanks (tiktoken's pattern would run out of stack) or a
    letter on which the two disagree go to the library itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes([byte_of[c] for c in t]): i for t, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.fast = tiktoken.Encoding("words", pat_str=WORD, mergeable_ranks=ranks, special_tokens={})
        self.guard = LetterGuard(self.fast.encode_ordinary, self.by_library)

    def by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or BLANKS.search(text) or not self.guard.trusts(text):
            return self.by_library(text)
        return self.fast.encode_ordinary(text)


@lru_cache(maxsize=2)
def byte_coder(path: str) -> ByteCoder:
    return ByteCoder(path)


def width(vocabulary: int) -> str:
    """The narrowest type for ids on their way to the files."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``mark`` and ``ids`` (numbers of ``width`` with the end id) of each document."""
    def run(batches):
        own = byte_coder(path)
        kind = width(own.size)
        for batch in batches:
            made = [np.array([*own.encode(t.as_py()), END_ID], kind).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["doc_id", "mark", "ids"])

    text = text_of()
    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64(text).alias("mark"), text.alias("_text")).mapInArrow(
        run, "doc_id bigint, mark bigint, ids binary")


def counts(tokens: DataFrame, kind: str) -> DataFrame:
    """``id``, ``n`` over all documents; each task counts before the shuffle."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                got = np.bincount(np.frombuffer(ids.as_buffer(), kind))
                if len(got) > len(total):
                    got[:len(total)] += total
                    total = got
                else:
                    total[:len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


SEGMENT = "part int, segment int, before bigint, n_ids bigint, doc_ids array<bigint>, sizes array<bigint>, payload binary"


def write(tokens: DataFrame, folder: str, vocabulary: int) -> None:
    """The files of all documents, in order of id."""
    spark = tokens.sparkSession
    found, kind = np.zeros(vocabulary, np.int64), width(vocabulary)
    for i, n in counts(tokens, kind).collect():  # one row for each id of the vocabulary
        found[i] = n
    freq = table_of(found)
    spark.createDataFrame(enumerate(freq.tolist()), "id int, freq bigint").coalesce(1).write.parquet(f"{folder}/table")
    table = spark.sparkContext.broadcast(freq.tobytes())

    def run(batches):
        coder = Coder(np.frombuffer(table.value, np.uint32))
        part, segment, before = TaskContext.get().partitionId(), 0, 0
        ids, docs, sizes, size = [], [], [], 0

        def close():
            nonlocal segment, before, ids, docs, sizes, size
            n = size
            row = pa.RecordBatch.from_pylist(
                [{"part": part, "segment": segment, "before": before, "n_ids": n, "doc_ids": docs, "sizes": sizes,
                  "payload": coder.encode(np.concatenate(ids))}], schema=shape)
            segment, before, ids, docs, sizes, size = segment + 1, before + n, [], [], [], 0
            return row

        shape = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                           ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("payload", pa.binary())])
        for batch in batches:
            for doc, data in zip(batch.column(0), batch.column(1)):
                own = np.frombuffer(data.as_buffer(), kind)
                ids.append(own)
                docs.append(doc.as_py())
                sizes.append(len(own))
                size += len(own)
                if size >= BLOCK:
                    yield close()
        if ids:
            yield close()

    ordered = tokens.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark").select("doc_id", "ids")
    ordered.mapInArrow(run, SEGMENT).write.parquet(f"{folder}/segments")
    spark.read.schema(SEGMENT).parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids")).write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` and ``ids`` of each document, from the files alone; checksums are verified."""
    rows = sorted(spark.read.parquet(f"{folder}/table").collect())  # one for each id of the vocabulary
    table = spark.sparkContext.broadcast(np.array([r["freq"] for r in rows], np.uint32).tobytes())
    ahead, total = {}, 0
    for part, n in sorted(map(tuple, spark.read.parquet(f"{folder}/manifest").collect())):  # one for each task that wrote
        ahead[part], total = total, total + n

    def run(batches):
        coder = Coder(np.frombuffer(table.value, np.uint32))
        for batch in batches:
            for part, before, docs, sizes, payload in zip(*[batch.column(i) for i in range(5)]):
                ids = coder.decode(payload.as_py()).astype("<u4")
                stops = np.cumsum(sizes.values.to_numpy())
                starts = np.concatenate([[0], stops[:-1]])
                first = ahead[part.as_py()] + before.as_py()
                yield pa.RecordBatch.from_arrays(
                    [docs.values, pa.array(starts + first), pa.array([ids[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary())],
                    names=["doc_id", "start", "ids"])

    segments = spark.read.schema(SEGMENT).parquet(f"{folder}/segments")
    return segments.select("part", "before", "doc_ids", "sizes", "payload").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def written(docs: DataFrame, path: str, folder: str | None = None) -> str:
    """Writes the files and returns their folder, by default a new one in the shared folder."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_root(spark)}/tokens-{uuid.uuid4().hex}"
    write(stage(token_ids(docs, path), "token-ids"), folder, byte_coder(path).size)
    return folder


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, as read back from its files."""
    back = read(docs.sparkSession, written(docs, path))
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
