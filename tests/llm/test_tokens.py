import hashlib
import random
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from smeltery.llm import bpe, token_counts, token_files  # noqa: E402
from smeltery.llm.rans import BLOCK, Coder, DamagedFile, table_of  # noqa: E402

ODD = ["<|endoftext|>a<|STARTOFTEXT|><|startoftext|>", "ΑΣ ΣΑΣ İstanbul", "Café Å", "'S it's'll", "a" * 3000,
       "՘֋ odd \x1c\x85　", "😀😀 <|endoftext|>", "  \n\n x", "x " * 500 + "\t"]


def all_texts(corpus):
    return [(i, t) for i, t, *_ in corpus] + [(1000 + k, t) for k, t in enumerate(ODD)]


def test_words_encode_like_the_library(docs_of, corpus):
    rows, path = all_texts(corpus), public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    got = bpe.encode(docs_of(rows), path, ["doc_id"], list(bpe.FIELDS)).collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids, text))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, r.decoded) for r in got) == sorted(want)


def test_speculation_equals_exact_merging():
    coder = bpe.coder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    words = ["".join(rng.choice("abdeinorst") for _ in range(rng.randint(1, 60))) for _ in range(3000)] + ["a" * n for n in range(1, 70)]
    m = coder.merges
    assert m.encode(words) == [m.exact(m.start(w, True)) for w in words]


@pytest.mark.parametrize("chunk,overlap", [(200, 16), (50, 4)])
def test_chunked_counts(chunk, overlap):
    counter = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"), chunk, overlap)
    rng = random.Random(3)
    for letters in ["abcdefghij ", "a", "ab", " ", "aé中😀 \n", "▁ a", "中文字"]:
        for _ in range(40):
            t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 1500)))
            assert counter.count(t) == len(counter.model.encode(t))


def test_counts(docs_of, corpus):
    rows = all_texts(corpus)
    path = public_tokenizers.path("piece_bpe_32k.model")
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs_of(rows), path).collect())
    want = []
    for i, t in rows:
        n = len(lib.encode(t or ""))
        want.append((str(i), len((t or "").encode()), n, n > 4096))
    assert got == sorted(want)


def test_range_coder():
    rng = np.random.default_rng(0)
    for n in (0, 1, 255, 256, 257, BLOCK, BLOCK + 1, 3 * BLOCK - 7):
        ids = np.minimum(rng.zipf(1.3, n), 5000) - 1
        coder = Coder(table_of(np.bincount(ids, minlength=5000)))
        data = coder.encode(ids)
        assert (coder.decode(data) == ids).all()
        if n > BLOCK:
            assert (coder.decode(data, 1) == ids[BLOCK:2 * BLOCK]).all()
    broken = bytearray(data)
    broken[-3000] ^= 4
    with pytest.raises(DamagedFile):
        coder.decode(bytes(broken))
    with pytest.raises(DamagedFile):
        Coder(table_of(np.arange(5000))).decode(data)


def test_files_read_back(docs_of, corpus):
    rows = [r for r in all_texts(corpus) if r[0] is not None]
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.digests(docs_of(rows), path).collect())
    at, left = 0, sorted((i, zlib.crc32(e.tobytes()), len(e)) for i, t in rows
                         for e in [np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")])
    for start, i, n, crc in got:
        assert start == at
        at += n
    assert sorted((i, crc, n) for _, i, n, crc in got) == left
    assert [i for _, i, _, _ in got] == sorted(i for i, _ in rows)


def test_empty(docs_of):
    none = docs_of([])
    assert bpe.encode(none, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"], ["n_tokens"]).count() == 0
    assert token_counts.token_counts(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert token_files.digests(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
