"""Alignment of two tokenizers: groups of tokens between common byte ends, and counts of linked ids.

Documents become rows of tokens in blocks of about ``BLOCK`` bytes. A short text is encoded whole. A very long one is
cut into byte ranges that any task can encode: a range begins, for each tokenizer, at the first byte from its start on
where no token can lie across, whatever the text around (``Aligner.cut``), so the two tokenizers' stretches differ, and
what one range can't close stays open (``fragments``). Open ends are composed in a tree over the ranges, a Spark shuffle
for each level; closed groups stay behind and are put in order at the end.

Two tokens whose byte ranges end together are linked; no token is empty, so every group holds one such pair, of its last
tokens. How often the corpus links a pair of ids is counted from the blocks' own counts. The answers then return to the
blocks: a block asks once for each of its pairs, so no pair's rows are gathered, and neither counts nor vocabulary are
broadcast, but for the highest count of each id of B (a row for each id of its vocabulary).

Null and empty texts, and those that the tokenizers don't give back byte by byte, have no tokens. Repeated rows count
each. Ids may be null or equal. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so other
columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import slices, text_of
from smeltery.llm.fragments import Fragment, Tokens, compose, fragment, no_tokens, written
from smeltery.llm.merges import byte_letters
from smeltery.llm.token_files import ByteCoder
from smeltery.session import stage

LONG = 131_072      # bytes; longer texts are cut into ranges
RANGE = 65_536      # bytes of a range
FAN = 8             # fragments composed by a task at a time
TOGETHER = 400_000  # bytes of short texts aligned at a time
BLOCK = 6_000_000   # bytes of texts that share a table of pairs

# Kinds of letters that every Unicode table of the byte vocabulary's word pattern sees alike.
BLANKS = " \t\n\r\x0b\x0c"
LETTERS = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F), (0x400, 0x481), (0x3041, 0x3096),
           (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
OTHERS = ((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E), (0x3001, 0x3003), (0xFF01, 0xFF0F))


@lru_cache(maxsize=65_536)
def kind(c: str) -> str:
    if c in BLANKS:
        return " "
    if "0" <= c <= "9":
        return "0"
    code = ord(c)
    for name, table in (("a", LETTERS), (".", OTHERS)):
        if any(low <= code <= high for low, high in table):
            return name
    return ""


class Aligner:
    """Both tokenizers, the bytes of their tokens, and where a text may be cut for either."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ByteCoder(a_path)
        self.a.special, self.a.library.encode_special_tokens = [], True   # their strings are plain text
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        self.a_bytes = [b""] * self.a.size
        for token, i in self.a.library.get_vocab(with_added_tokens=False).items():
            self.a_bytes[i] = bytes([byte_of[c] for c in token])
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size = len(pieces)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # Neighbours inside some piece; no merge ever joins others.
        self.joined = {pair for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))
                       for pair in zip(p, p[1:])}
        self.lead = self.b.encode("\n")   # a line feed keeps the model's own leading space away from a range
        if any("\n" in pair for pair in self.joined):
            raise ValueError("The piece vocabulary joins line feeds, so ranges can't be encoded alone")

    def a_ids(self, text: str) -> list[int]:
        return self.a.encode(text)

    def b_ids(self, text: str) -> list[int]:
        """Of a stretch of space and text."""
        return self.b.encode("\n" + text)[len(self.lead):] if text else []

    @staticmethod
    def a_cut(left: str, right: str) -> bool:
        """Whether words end between two letters in any text: runs of one kind end there, and a blank begins the next
        word. After blanks, and behind an apostrophe, it depends on what stands before."""
        x, y = kind(left), kind(right)
        return bool(x and y) and x != " " and x != y and not (left == "'" and y == "a")

    def b_cut(self, left: str, right: str) -> bool:
        return (left.replace(" ", "▁"), right.replace(" ", "▁")) not in self.joined

    def tokens(self, text: str, given: bool = True) -> Tokens | None:
        """Tokens of a whole text behind a space; none if their bytes differ from it."""
        data = text.encode()
        a, b = self.a_ids(text), self.b.encode(text[1:]) if given else self.b_ids(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        return Tokens(a, np.cumsum(self.a_sizes[a]), b, np.cumsum(self.b_sizes[b]))

    def stretch(self, text: str, start: int, ids: Callable, table: list[bytes], sizes: np.ndarray):
        """Ids and ends of one tokenizer's stretch; None if it doesn't give back its bytes."""
        found = ids(text)
        if b"".join(map(table.__getitem__, found)) != text.encode():
            return None
        found = np.array(found, np.int64)
        return found, start + np.cumsum(sizes[found])


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def borders(text: str, sizes: np.ndarray, step: int, cut: Callable[[str, str], bool]) -> list[int]:
    """For each multiple of ``step`` bytes the first place (in letters) from there on where ``cut`` allows it.

    ``sizes`` has the bytes before each letter. Places already passed aren't looked at again.
    """
    out, n = [0], len(text)
    for low in range(step, int(sizes[-1]), step):
        at = max(int(np.searchsorted(sizes, low)), out[-1])
        while at < n and not (at and cut(text[at - 1], text[at])):
            at += 1
        out.append(at)
    return out + [n]


def ranges(own: Aligner, text: str, step: int) -> Iterator[tuple]:
    """The ranges of a text behind a space: number, first byte and string of A's stretch, and of B's."""
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4")
    sizes = np.concatenate([[0], np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF).astype(np.int64))])
    a, b = (borders(text, sizes, step, cut) for cut in (own.a_cut, own.b_cut))
    for k in range(len(a) - 1):
        low, high = min(a[k], b[k]), max(a[k + 1], b[k + 1])
        yield (k, text[low:high], a[k] - low, a[k + 1] - low, int(sizes[a[k]]), b[k] - low, b[k + 1] - low, int(sizes[b[k]]))


ROW = "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, codes binary, keys array<bigint>, times array<bigint>"
NAMES = [x.strip().split(" ")[0] for x in ROW.split(",")]


class Block:
    """Rows of documents that share a table of linked pairs; each row's links are places in the table."""

    def __init__(self, number: int):
        self.number, self.rows, self.links, self.size = number, [], [], 0

    def add(self, doc_id, n_a: int, n_b: int, n_groups: int, digest: str, links: np.ndarray, size: int) -> None:
        self.rows.append((doc_id, n_a, n_b, n_groups, digest))
        self.links.append(links)
        self.size += size

    def batch(self) -> pa.RecordBatch:
        """The documents' rows, and one row with the table: pairs and how often the block links them."""
        keys, codes, times = np.unique(np.concatenate([np.zeros(0, np.int64), *self.links]), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(x) for x in self.links])[:-1]
        packed = [c.tobytes() for c in np.split(codes.astype("<u4"), ends)] if self.links else []
        n = len(self.rows)
        columns = [*map(list, zip(*self.rows))] if n else [[] for _ in range(5)]
        arrays = [pa.array(c + [None], t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.string()])]
        lists = [pa.array([None] * n + [x], pa.list_(pa.int64())) for x in (keys, times)]
        return pa.RecordBatch.from_arrays([pa.array([self.number] * (n + 1), pa.int64()), *arrays, pa.array(packed + [None], pa.binary()), *lists], names=NAMES)


def aligned(own: Aligner, texts: list[str]) -> list[tuple]:
    """Counts, digest and links of whole texts, aligned side by side."""
    held, base = [], 0
    for text in texts:
        found = own.tokens(" " + text) if text else None
        held.append((found, base))
        if found is not None:
            base += int(found.a_end[-1])
    good = [(t, b) for t, b in held if t is not None]
    if not good:
        return [(0, 0, 0, "", np.zeros(0, np.int64))] * len(texts)
    whole = Tokens(np.concatenate([t.a for t, _ in good]), np.concatenate([t.a_end + b for t, b in good]),
                   np.concatenate([t.b for t, _ in good]), np.concatenate([t.b_end + b for t, b in good]))
    text, stops, last_a, last_b = written(whole)
    links, cuts, view = last_a * own.size + last_b, whole.cuts(), memoryview(text)
    out, at, begin = [], 0, 0
    for found, base in held:
        if found is None:
            out.append((0, 0, 0, "", np.zeros(0, np.int64)))
            continue
        to = int(np.searchsorted(cuts, base + found.a_end[-1], "right"))
        stop = int(stops[to - 1])
        out.append((len(found.a), len(found.b), to - at, hashlib.sha256(view[begin:stop - 1]).hexdigest(), links[at:to]))
        at, begin = to, stop
    return out


def numbers(task: int) -> Iterator[int]:
    """Numbers of blocks that no other task gives."""
    n = task << 32
    while True:
        yield n
        n += 1


def short_rows(docs: DataFrame, a_path: str, b_path: str, side: int) -> DataFrame:
    def run(batches):
        from pyspark import TaskContext

        own, number = aligner(a_path, b_path), numbers(TaskContext.get().partitionId() * 2 + side)
        block = Block(next(number))
        for batch in batches:
            for part in slices(batch, 1, TOGETHER):
                texts = part.column(1).to_pylist()
                for doc_id, text, got in zip(part.column(0).to_pylist(), texts, aligned(own, texts)):
                    block.add(doc_id, *got, len(text) + 100)
                if block.size > BLOCK:
                    yield block.batch()
                    block = Block(next(number))
        if block.rows:
            yield block.batch()

    return docs.mapInArrow(run, ROW)


ENDS = [f"{side}_{x}" for side in ("prefix", "suffix") for x in ("a", "a_end", "b", "b_end")]
OPEN = ("row bigint, doc_id bigint, place bigint, good boolean, first bigint, last bigint, "
        + ", ".join(f"{x} binary" for x in ENDS))
CLOSED = "row bigint, doc_id bigint, at bigint, good boolean, n_a bigint, n_b bigint, groups binary, links binary, size bigint"


def pack(f: Fragment) -> list[bytes]:
    return [x.astype("<i8").tobytes() for t in (f.prefix, f.suffix) for x in t.parts()]


def unpack(r: dict) -> Fragment:
    parts = [np.frombuffer(r[x], "<i8") for x in ENDS]
    return Fragment(Tokens(*parts[:4]), Tokens(*parts[4:]), r["first"], r["last"])


def closed_row(row: int, doc_id, at: int, good: bool, n_a: int, n_b: int, closed: Tokens, width: int, size: int) -> dict:
    text, _, last_a, last_b = written(closed)
    return {"row": row, "doc_id": doc_id, "at": at, "good": good, "n_a": n_a, "n_b": n_b, "groups": text,
            "links": (last_a * width + last_b).astype("<i8").tobytes(), "size": size}


def long_rows(docs: DataFrame, a_path: str, b_path: str, side: int, step: int, fan: int) -> DataFrame | None:
    """Rows of very long documents, by way of ranges; None where there are no such documents."""
    schema = "row bigint, doc_id bigint, place bigint, part string, a0 int, a1 int, a_at bigint, b0 int, b1 int, b_at bigint"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def cut(batches):
        own = aligner(a_path, b_path)
        for batch in batches:
            for row, doc_id, text in zip(*[batch.column(i) for i in range(3)]):
                for some in grouped(ranges(own, " " + text.as_py(), step), 32):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (row.as_py(), doc_id.as_py(), *r))) for r in some],
                                                     pa.schema([(n, pa.string() if n == "part" else pa.int32() if n[1:] in "01" else pa.int64()) for n in names]))

    def encode(batches):
        own = aligner(a_path, b_path)
        for batch in batches:
            for r in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                a = own.stretch(r["part"][r["a0"]:r["a1"]], r["a_at"], own.a_ids, own.a_bytes, own.a_sizes)
                b = own.stretch(r["part"][r["b0"]:r["b1"]], r["b_at"], own.b_ids, own.b_bytes, own.b_sizes)
                good = a is not None and b is not None
                ends, closed = fragment(Tokens(*a, *b)) if good else (Fragment(no_tokens()), no_tokens())
                open_part = {"place": r["place"], "first": ends.first, "last": ends.last, **dict(zip(ENDS, pack(ends)))}
                row = closed_row(r["row"], r["doc_id"], -1 if ends.first is None else ends.first, good, len(a[0]) if good else 0,
                                 len(b[0]) if good else 0, closed, own.size, len(r["part"]))
                yield pa.RecordBatch.from_pylist([{**row, **open_part}], BOTH)

    BOTH = arrow_schema(CLOSED + ", place bigint, first bigint, last bigint, " + ", ".join(f"{x} binary" for x in ENDS))
    cut_up = docs.mapInArrow(cut, schema)
    made = stage(cut_up.repartition("row", "place").mapInArrow(encode, ", ".join(f"{f.name} {SPARK[f.type]}" for f in BOTH)), "ranges")
    places = made.agg(F.max("place")).first()[0]
    if places is None:
        return None
    closed = [made.select(*column_names(CLOSED))]
    open_ends = made.select(*column_names(OPEN))
    while True:
        last = places < fan   # this round leaves one fragment of each document
        made = stage(composed(open_ends, a_path, b_path, fan, last), "fragments")
        closed.append(made.where("at is not null").select(*column_names(CLOSED)))
        if last:
            break
        open_ends, places = made.where("place is not null").select(*column_names(OPEN)), places // fan
    groups = closed[0]
    for more in closed[1:]:
        groups = groups.unionByName(more)
    return ordered(groups, a_path, b_path, side)


SPARK = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.binary(): "binary", pa.int32(): "int", pa.string(): "string"}


def column_names(ddl: str) -> list[str]:
    return [x.strip().split(" ")[0] for x in ddl.split(",")]


def arrow_schema(ddl: str) -> pa.Schema:
    of = {v: k for k, v in SPARK.items()}
    return pa.schema([(x.strip().split(" ")[0], of[x.strip().split(" ")[1]]) for x in ddl.split(",")])


def grouped(rows, size: int):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def composed(open_ends: DataFrame, a_path: str, b_path: str, fan: int, last: bool) -> DataFrame:
    """One level of the tree: each run of ``fan`` fragments of a document as one, and the groups that this closes."""
    ddl = CLOSED + ", place bigint, first bigint, last bigint, " + ", ".join(f"{x} binary" for x in ENDS)

    def run(key, table):
        own = aligner(a_path, b_path)
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        row, doc_id, good = rows[0]["row"], rows[0]["doc_id"], all(r["good"] for r in rows)
        whole, out = unpack(rows[0]), []

        def close(tokens: Tokens) -> None:
            if len(tokens.a):
                # In order these come where their first group begins; what a range has closed begins at its first cut.
                at = int(tokens.cuts()[0]) - 1
                out.append(closed_row(row, doc_id, at, good, 0, 0, tokens, own.size, 0))

        for r in rows[1:] if good else []:
            whole, tokens = compose(whole, unpack(r))
            close(tokens)
        if last and good:
            close(whole.prefix)   # the text's start is a cut as well, and its end closes the last group
        elif not last:
            out.append({"row": row, "doc_id": doc_id, "good": good, "place": rows[0]["place"] // fan, "first": whole.first, "last": whole.last,
                        **dict(zip(ENDS, pack(whole)))})
        return pa.Table.from_pylist(out, arrow_schema(ddl))

    level = F.floor(F.col("place") / fan).alias("level")
    return open_ends.groupBy("row", level).applyInArrow(run, ddl)


def ordered(groups: DataFrame, a_path: str, b_path: str, side: int) -> DataFrame:
    """Documents' rows from their closed groups, read in order of the text one after the other."""
    def run(batches):
        from pyspark import TaskContext

        own, number = aligner(a_path, b_path), numbers(TaskContext.get().partitionId() * 2 + side)
        block, now = Block(next(number)), None

        def finish() -> None:
            _, doc_id, good, n_a, n_b, n, digest, links, size = now
            nothing = 0, 0, 0, "", np.zeros(0, np.int64)
            block.add(doc_id, *((n_a, n_b, n, digest.hexdigest(), np.concatenate(links)) if good else nothing), size)

        for batch in batches:
            for r in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if now is None or now[0] != r["row"]:
                    if now is not None:
                        finish()
                        if block.size > BLOCK:
                            yield block.batch()
                            block = Block(next(number))
                    now = [r["row"], r["doc_id"], True, 0, 0, 0, hashlib.sha256(), [], 0]
                links = np.frombuffer(r["links"], "<i8")
                now[2] = now[2] and r["good"]
                now[3] += r["n_a"]
                now[4] += r["n_b"]
                now[8] += r["size"]
                if len(links):
                    if now[5]:
                        now[6].update(b";")
                    now[6].update(memoryview(r["groups"])[:-1])
                    now[5] += len(links)
                    now[7].append(links)
        if now is not None:
            finish()
            yield block.batch()

    spread = groups.repartition("row").sortWithinPartitions("row", "at")
    return spread.mapInArrow(run, ROW)


def alignment(docs: DataFrame, a_path: str, b_path: str, long: int = LONG, step: int = RANGE, fan: int = FAN) -> DataFrame:
    """Of every document the tokens of both, groups, links, links that are their B id's best, counts and the groups' digest."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    size = F.octet_length("text")
    short = source.where(size <= long)
    huge = source.where(size > long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    parts = stage(short_rows(short, a_path, b_path, 0), "aligned")
    if (more := long_rows(huge, a_path, b_path, 1, step, fan)) is not None:
        parts = parts.unionByName(stage(more, "aligned-long"))
    width = aligner(a_path, b_path).size
    asked = parts.where("keys is not null").select("block", F.posexplode(F.arrays_zip("keys", "times")).alias("code", "pair"))
    asked = asked.select("block", "code", F.col("pair.keys").alias("pair"), F.col("pair.times").alias("times"))
    totals = stage(asked.groupBy("pair").agg(F.sum("times").alias("n")), "pairs")
    best = totals.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("best"))
    known = totals.join(F.broadcast(best), F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("best")).alias("best"))
    answers = asked.select("block", "code", "pair").join(known, "pair").select(F.col("block").alias("asker"), "code", "n", "best")
    rows = parts.where("codes is not null").select("block", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes")

    def judge(left, right):
        order = np.argsort(right["code"].to_numpy())
        n, best = right["n"].to_numpy()[order], right["best"].to_numpy(zero_copy_only=False)[order] if len(order) else np.zeros(0, bool)
        codes = [np.frombuffer(c.as_buffer(), "<u4") for c in left["codes"]]
        return pa.table({
            **{c: left[c] for c in ("doc_id", "n_a", "n_b", "n_groups")}, "n_links": left["n_groups"],
            "n_best": pa.array([int(best[c].sum()) for c in codes], pa.int64()),
            "count_sum": pa.array([int(n[c].sum()) for c in codes], pa.int64()), "groups_sha256": left["groups_sha256"]})

    return rows.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(
        judge, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
