import re

from smeltery.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text or "")
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force(docs_of, corpus):
    got = {}
    for r in q.quality(docs_of(corpus)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
    want = {}
    for i, t, *_ in corpus:
        want.setdefault(i, []).append(counts(t))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_verdicts(docs_of, corpus):
    rows = q.quality(docs_of(corpus)).collect()
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert {r.doc_id for r in rows if r.base_failed} >= {100, 101, 102, 401, 402}


def test_odd_documents_go_and_usual_ones_stay(docs_of):
    usual = [(i, " ".join(f"word{i}x{k}" for k in range(60))) for i in range(80)]
    odd = [(500, " ".join(f"a{k}&&&" for k in range(60))), (501, " ".join(f"SHOUTING{k}" for k in range(60)))]
    kept = {r.doc_id for r in q.keep_good(docs_of(usual + odd)).collect()}
    assert kept == {i for i, _ in usual}


def test_stage_keeps_columns_and_empty_input(docs_of, corpus):
    docs = docs_of(corpus)
    assert q.keep_good(docs).columns == docs.columns
    assert q.quality(docs_of([])).count() == 0


def test_one_document_more_moves_cutoffs_but_little(docs_of):
    plain = [(i, " ".join(f"word{i}x{k}" for k in range(40)), "big") for i in range(300)]
    loud = [(1000 + i, " ".join(f"LOUD{k}" if k % 2 else f"quiet{k}{i}" for k in range(40)), "small") for i in range(52)]
    cuts = []
    for n in (1, 10, 48, 49, 50, 51, 52):
        found = {r.max_upper_rate for r in q.quality(docs_of(plain + loud[:n])).collect() if r.doc_id >= 1000}
        assert len(found) == 1
        cuts.append(found.pop())
    assert cuts == sorted(cuts) and cuts[-1] > cuts[0]
    assert max(b - a for a, b in zip(cuts[2:], cuts[3:])) <= 5
