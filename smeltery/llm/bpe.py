"""BPE encoding and decoding of documents with a public word vocabulary.

Texts are cut into words as the vocabulary's own rules say (canonical composition, lower case, white
space dropped, special strings kept whole). Each task keeps the ids of words it has seen, up to a
bound; new words of a batch are encoded together (``merges``). Decoding joins the tokens of the ids.

Null text counts as empty and gives no ids. Repeated rows give the same result each, an empty table an
empty result. Only the columns in ``keep`` are read beside the text, so clashing names can't meet. A lone
surrogate can't occur, as Spark strings are UTF-8.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from smeltery.llm.common import slices, text_of
from smeltery.llm.letters import LetterGuard
from smeltery.llm.merges import Merges

# The word pattern of the vocabulary file.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SEEN_WORDS = 150_000     # words a task remembers, twice
LONG_WORD = 64           # longer ones are not remembered


class WordCoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        self.special = {t["content"]: t["id"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}
        self.names = {i: t for t, i in self.special.items()}
        self.library = Tokenizer.from_file(path)
        self.bytes_of = {c: b for b, c in enumerate(self.merges.letters)}
        self.guard = LetterGuard(self.by_pattern, self.by_library)
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        # Words seen lately and, to be taken over when they come again, those seen before.
        self.seen: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}

    def words(self, text: str) -> list[str]:
        if "<|" in text:
            out = []
            for part in self.split.split(text):
                out += ["\0" + part] if part in self.special else self.plain(part)
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        return self.by_pattern(text) if self.guard.trusts(text) else self.by_library(text)

    @staticmethod
    def by_pattern(text: str) -> list[str]:
        if not text.isascii():
            # Letter by letter, a capital sigma has one lower case.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return WORD.findall(text.lower())

    def by_library(self, text: str) -> list[str]:
        """The words as the tokenizers library cuts them: for letters its Unicode tables see otherwise."""
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes([self.bytes_of[c] for c in piece]).decode("utf-8") for piece, _ in cut]

    def learn(self, docs: list[list[str]]) -> dict[str, tuple[bytes, str]]:
        """What all words of these documents encode and decode to."""
        distinct = set().union(*docs)
        if len(self.seen) > SEEN_WORDS:
            self.older, self.seen = self.seen, {}
        known = self.seen
        new = []
        for w in distinct.difference(known):
            if (had := self.older.get(w)) is not None:
                known[w] = had
            elif w[0] == "\0" and w[1:] in self.special:
                known[w] = (array("I", [self.special[w[1:]]]).tobytes(), w[1:])
            else:
                new.append(w)
        for at in range(0, len(new), 50_000):
            some = new[at:at + 50_000]
            for w, ids in zip(some, self.merges.encode(some)):
                known[w] = (array("I", ids).tobytes(), " ".join([self.merges.tokens[i] for i in ids]))
        if any(len(w) > LONG_WORD for w in new):
            self.seen = {k: v for k, v in known.items() if len(k) <= LONG_WORD}
        return known

    def decode(self, ids) -> str:
        return " ".join([self.names.get(i) or self.merges.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


FIELDS = {"n_tokens": (T.LongType(), pa.int64()), "ids_sha256": (T.StringType(), pa.string()),
          "decoded_sha256": (T.StringType(), pa.string()), "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), "decoded": (T.StringType(), pa.string())}
GROUP_BYTES = 2_000_000  # of texts encoded together and sent on as one batch


def encode(docs: DataFrame, path: str, keep: list[str], fields: list[str]) -> DataFrame:
    """The ``keep`` columns and of each text the ``fields``: ids, decoded text, their count and digests.

    A task holds the words and ids of one group of texts at a time, ids as bytes, never as Python numbers.
    """
    source = docs.select(*[F.col(f"`{c}`") for c in keep], text_of().alias("_text"))
    schema = T.StructType([*source.schema.fields[:-1], *[T.StructField(k, FIELDS[k][0]) for k in fields]])

    def run(batches):
        own = coder(path)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, GROUP_BYTES):
                split = [own.words(t.as_py()) for t in part.column(part.num_columns - 1)]
                known = own.learn(split)
                made = {k: [] for k in fields}
                for i, words in enumerate(split):
                    split[i] = None
                    got = [known[w] for w in words]
                    ids = b"".join([g[0] for g in got])
                    if "n_tokens" in made:
                        made["n_tokens"].append(len(ids) // 4)
                    if "ids_sha256" in made:
                        made["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    if "ids" in made:
                        made["ids"].append(ids)
                    if "decoded_sha256" in made or "decoded" in made:
                        text = " ".join([g[1] for g in got])
                        if "decoded" in made:
                            made["decoded"].append(text)
                        if "decoded_sha256" in made:
                            made["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                columns = [id_lists(made[k]) if k == "ids" else pa.array(made[k], FIELDS[k][1]) for k in fields]
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + columns, names=[*keep, *fields])

    return source.mapInArrow(run, schema)


def id_lists(rows: list[bytes]) -> pa.Array:
    """Lists of ids over one buffer."""
    ends = np.cumsum([0, *[len(r) // 4 for r in rows]])
    flat = pa.py_buffer(b"".join(rows))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, flat]))
