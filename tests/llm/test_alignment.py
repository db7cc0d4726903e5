"""Alignment of the two tokenizers against a plain one, and fragments under any composition."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from conftest_text import prose  # noqa: E402
from smeltery.llm import alignment as q, fragments as f  # noqa: E402
from smeltery.llm.merges import byte_letters  # noqa: E402

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["<|endoftext|> and <|endoftext|>x", "a▁b", "<s>x</s><unk><0x0A>", "é日本😀 \t x  y ", "\r\n", " ", "\n", "a\x00b", "don't we'll 's ''s", "x" * 400, "1 2  3   4", "　x​\xa0"]


@pytest.fixture(scope="module")
def plain():
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: b for b, c in enumerate(byte_letters())}

    def groups(text):
        if not text:
            return None
        a = [(i, bytes(byte_of[c] for c in lib.id_to_token(i))) for i in lib.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode())
             for i in model.encode(text)]
        data = (" " + text).encode()
        if b"".join(t for _, t in a) != data or b"".join(t for _, t in b) != data:
            return None
        out, held, ends = [], ([], []), [0, 0]
        at = [0, 0]
        while at[0] < len(a) or at[1] < len(b):
            k = 0 if ends[0] <= ends[1] and at[0] < len(a) else 1
            token, size = (a, b)[k][at[k]]
            held[k].append(token)
            ends[k] += len(size)
            at[k] += 1
            if ends[0] == ends[1]:
                out.append(held)
                held = ([], [])
        return out

    return groups


def brute(plain, rows):
    made = [(i, plain(t or "")) for i, t in rows]
    count = Counter((g[0][-1], g[1][-1]) for _, gs in made if gs for g in gs)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, gs in made:
        links = [(g[0][-1], g[1][-1]) for g in gs or []]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs or [])
        out.append((str(i), sum(len(a) for a, _ in gs or []), sum(len(b) for _, b in gs or []), len(links), len(links),
                    sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if gs else ""))
    return sorted(out)


def result(frame):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in frame.collect())


@pytest.mark.parametrize("sizes", [{}, {"long": 300, "step": 64, "fan": 2}, {"long": 100, "step": 40, "fan": 8}])
def test_documents(plain, docs_of, corpus, sizes):
    rng = random.Random(4)
    rows = [(i, t) for i, t, *_ in corpus] + [(1000 + k, t) for k, t in enumerate(ODD)]
    rows += [(2000, "x" * 900 + " y" * 300), (2001, "日本語。" * 300), (2002, prose(rng, 300) + " a▁b " + prose(rng, 300)),
             (2003, "".join(rng.choice("ab 1.'é日 \n") for _ in range(3000))), (2004, " " * 700), (2005, "it's " * 200), (2005, "it's " * 200)]
    assert result(q.alignment(docs_of(rows).repartition(3), A, B, **sizes)) == brute(plain, rows)


def test_empty(docs_of):
    assert q.alignment(docs_of([]), A, B).count() == 0
    assert result(q.alignment(docs_of([(1, None), (2, "")]), A, B)) == [("1", 0, 0, 0, 0, 0, 0, ""), ("2", 0, 0, 0, 0, 0, 0, "")]


def test_cuts_keep_tokens():
    own, rng = q.aligner(A, B), random.Random(6)
    for letters in ("ab 1.'é日 \n", "a'sl ", "x. ,;1 \t", "日。本、あア", "▁ a"):
        for _ in range(60):
            text = " " + "".join(rng.choice(letters) for _ in range(rng.randint(1, 300)))
            for cut, ids in ((own.a_cut, own.a_ids), (own.b_cut, own.b_ids)):
                places = [0, *[i for i in range(1, len(text)) if cut(text[i - 1], text[i])], len(text)]
                assert sum([ids(text[i:j]) for i, j in zip(places, places[1:])], []) == ids(text), text


def test_fragments_compose_in_any_order():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 60)
        ends = [np.array(sorted({n, *rng.sample(range(1, n + 1), rng.randint(1, n))})) for _ in range(2)]
        tokens = f.Tokens(np.arange(len(ends[0])), ends[0], np.arange(len(ends[1])) + 100, ends[1])
        parts, low = [], [0, 0]
        while low != [n, n]:
            high = [min(n, x + rng.randint(0, 20)) for x in low]
            parts.append(f.Tokens(*tokens.between(low[0], high[0]).parts()[:2], *tokens.between(low[1], high[1]).parts()[2:]))
            low = high
        closed, row = [], []
        for p in parts:
            whole, inner = f.fragment(p)
            row.append(whole)
            closed.append(inner)
        row.insert(rng.randrange(len(row) + 1), f.Fragment(f.no_tokens()))   # the unit
        while len(row) > 1:
            k = rng.randrange(len(row) - 1)
            row[k:k + 2], inner = [f.compose(row[k], row[k + 1])[0]], f.compose(row[k], row[k + 1])[1]
            closed.append(inner)
        closed.append(row[0].prefix)
        assert not len(row[0].suffix.a) and not len(row[0].suffix.b)
        closed = sorted((c for c in closed if len(c.a)), key=lambda c: c.a_end[0])
        assert b"".join(f.written(c)[0] for c in closed) == f.written(tokens)[0]


def test_written():
    t = f.Tokens(np.array([1, 23, 456]), np.array([2, 5, 9]), np.array([7, 89, 31999]), np.array([5, 7, 9]))
    text, stops, a, b = f.written(t)
    assert text == b"1,23|7;456|89,31999;" and stops.tolist() == [7, 20] and (a.tolist(), b.tolist()) == ([23, 456], [7, 31999])
