import random

from smeltery.llm import pii as q


def tagger():
    table = [([t[a:b] for a, b in w], q.labelled(w, s)) for t, s in q.made_up() for w in q.windows(t)]
    return q.Tagger.fit(table)


def test_long_contact_lists():
    # Every span of a run of many windows is found, wherever it stands.
    field, rng = tagger(), random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    makers = {"phone": lambda: f"({number(3)}) {number(3)}-{number(4)}", "email": lambda: f"{rng.choice(['anter', 'loshi', 'qua'])}.lo [at] {rng.choice(['romi', 'shen'])} [dot] org"}
    for kind, make in makers.items():
        for apart in (" call ", " lomi sh "):
            text, want = "see", []
            for _ in range(60):
                text += apart
                value = make()
                want.append((kind, len(text), len(text) + len(value)))
                text += value
            text += apart + "lo lomi sh"
            assert field.added([text], [q.base_spans(text)])[0] == want


def test_views_cover_each_word_once():
    text = " ".join(f"a{k} 5" for k in range(100))
    words = [w for v, a, b in q.views(text) for w in v[a:b]]
    assert words == q.windows(text, 10**9, True)[0] and len(words) > 190
    assert max(len(v) for v, *_ in q.views(text)) == 3 * q.MARGIN
