"""The fixed patterns against the contract's expressions as they stand, and long runs in linear time."""

import hashlib
import random
import re
import time

import pytest

from smeltery.llm import pii as q

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain(text):
    out = []
    for kind, pattern in CONTRACT.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
            if {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, *m.span()))
    return out


def test_random_texts():
    rng = random.Random(8)
    for letters in ("a1@.-", "0123456789 .-+()", "ab@@..__", "12.3", "é1. +@x", "0.@a"):
        for _ in range(4000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
            assert q.base_spans(text) == plain(text), text
    assert q.base_spans("0" * 40 + "1.2.3." + "0" * 50 + "9") == [("ip", 0, 97)]


def test_corpus(docs_of, corpus):
    rng = random.Random(2)
    bits = ["ann.lo@shen.example.org", "10.0.0.7", "4111 1111 1111 1111", "+1 (632) 555-4827", "a@b", "999.1.1.1", "é@x.y", "4111-1111-1111-1112"]
    rows = [(i, t) for i, t, *_ in corpus] + [(5000 + i, " ".join(rng.choice(bits) for _ in range(rng.randint(1, 30)))) for i in range(60)]
    got = q.personal_data(docs_of(rows)).collect()
    want = {}
    for i, text in rows:
        spans = plain(text or "")
        counts = tuple(sum(k == kind for k, _, _ in spans) for kind in q.KINDS)
        want.setdefault(i, []).append((hashlib.sha256(q.joined(spans).encode()).hexdigest(), counts))
        assert spans == sorted(spans, key=lambda s: (q.KINDS.index(s[0]), s[1]))
    have = {}
    for r in got:
        have.setdefault(r.doc_id, []).append((r.base_sha256, (r.n_email, r.n_ip, r.n_card, r.n_phone)))
        assert set(filter(None, q.joined(plain(dict(rows)[r.doc_id] or "")).split(","))) <= set(r.spans.split(","))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("text", ["7" * 1_000_000, "a" * 1_000_000 + " x@y", "@" * 1_000_000, "a@" * 500_000, "1." * 500_000,
                                  "1-" * 500_000, "+1" * 500_000, "+1" + "(" * 1_000_000, "a.b-" * 250_000 + "@"])
def test_a_megabyte_in_a_second(text):
    began = time.perf_counter()
    q.base_spans(text)
    assert time.perf_counter() - began < 1.0


def test_long_runs_through_the_field(docs_of):
    rows = [(1, "7" * 300_000), (2, "@" * 100_000 + " b"), (3, "1.2 " * 20_000)]
    assert q.personal_data(docs_of(rows)).count() == 3


def test_spellings_in_any_case(docs_of):
    rows = [(1, "write to ANN.LO AT SHEN DOT ORG now"), (2, "write to ann.lo at shen dot org now"), (3, "Lomi Anter At Shen Dot Com Ro")]
    got = {r.doc_id: r.spans for r in q.personal_data(docs_of(rows)).collect()}
    assert got[1] == got[2] == "email:9:31" and got[3].startswith("email:")
