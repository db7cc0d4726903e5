import random

from smeltery.llm import pii as q


def test_patterns():
    text = "+1 (632) 555-4827 a@b.co 1.2.3.4 300.1.1.1 4111111111111111 4111111111111112"
    assert [(k, text[s:e]) for k, s, e in q.base_spans(text)] == [
        ("email", "a@b.co"), ("ip", "1.2.3.4"), ("phone", "+1 (632) 555-4827")]
    assert q.base_spans("x 4111111111111111, 4111111111111112") == [("card", 2, 18)]
    kinds = q.joined(q.base_spans("x a@b.co é 1.2.3.4"))
    assert kinds == "email:2:8,ip:11:18"


def test_held_out_accuracy():
    rows = q.made_up()
    random.Random(3).shuffle(rows)
    cut = len(rows) * 3 // 4
    table = [([t[a:b] for a, b in w], q.labelled(w, s)) for t, s in rows[:cut] for w in q.windows(t)]
    tagger = q.Tagger.fit(table)
    test = [([t[a:b] for a, b in w], q.labelled(w, s)) for t, s in rows[cut:] for w in q.windows(t)]
    got = tagger.label([w for w, _ in test])
    right = sum(g == y for (_, y), g in zip(test, got))
    assert right / len(test) > 0.9


def test_documents(docs_of, corpus):
    rows = corpus + [(900, "reach me at (555) 123-4567 today"), (901, "é mail anter.lomi [at] shen [dot] org now"), (902, "Version 2.0 of 1999"),
                     (903, "ann@x.example.com and +1 (632) 555-4827")]
    got = {r.doc_id: r for r in q.personal_data(docs_of(rows)).collect()}
    assert got[900].spans == "phone:12:26" and got[900].n_phone == 0
    assert got[901].spans.startswith("email:7:")
    assert got[902].spans == "" and got[100].spans == ""
    assert (got[903].n_email, got[903].n_phone) == (1, 1) and got[903].spans == "email:0:17,phone:22:39"
    assert q.personal_data(docs_of([])).count() == 0
    assert q.personal_data(docs_of(rows)).count() == len(rows)
