"""Personal data in texts: fixed patterns, and a conditional random field for what they miss.

The patterns find emails, network addresses, card and phone numbers; their spans always stay. The
field labels words by their shapes and those of their neighbours. It is trained on a small labelled
table: words around digits and at signs from a bounded sample of the documents, labelled by the
patterns, and a few made-up lines with spellings that the patterns don't know (phone numbers without
a plus sign, addresses spelled with "at" and "dot"). It labels only near digits, at signs and such
spellings, as a span always holds one. Its spans are added where they meet none of the patterns.

Places count code points. Null text counts as empty. Repeated rows give the same result each. With
an empty table the field knows the made-up lines alone. Only ``doc_id`` and ``text`` are read, so other
columns may have any name. Patterns and field read a text of any length in linear time.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from smeltery.llm.common import text_of
from smeltery.llm.crf import Chain, padded
from smeltery.session import stage

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract.
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"   # before the at sign
HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")                                 # after it
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
SPARK = re.compile(r"[0-9@]|(?<!\S)[\[({]?(?:at|dot)[\])}]?(?!\S)", re.I)
WORD = re.compile(r"\S+")
SPELLED = re.compile(r"\S+@\S+|\S+\s+[\[({]?at[\])}]?\s+\S+(\s+[\[({]?dot[\])}]?\s+[A-Za-z]{2,12})+", re.I)
AROUND = 3            # words taken on either side of a digit or at sign
LONGEST = 16          # words of a window of the labelled table
LONGEST_EMAIL = 320   # code points of a spelled email that the field adds
MARGIN = 16           # words labelled on either side of those that a part of a run answers for; a span has fewer
SAMPLE = 1500         # windows of the corpus in the labelled table
EXAMPLES = 500        # made-up lines in it
CASED = 60            # pairs of made-up lines in other cases
LABELS = ["O", *[f"{b}-{k}" for k in KINDS for b in "BI"]]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(DIGIT.findall(s))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of emails. A match begins where the run of name signs before an at sign begins, or where the
    match before ended, so one look back from each at sign finds it and a text is read once."""
    least, at = 0, text.find("@")
    while at >= 0:
        start = least + len(text[least:at].rstrip(NAME))
        host = HOST.match(text, at + 1) if start < at else None
        least = host.end() if host else at + 1
        if host:
            yield start, least
        at = text.find("@", least)


def is_part(digits: str) -> bool:
    """Whether a part of an address is at most 255, however many zeros lead it."""
    value = digits.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind, then by start, in time linear in the text.

    An address can only begin where a run of digits begins: from inside a run the same dots follow.
    """
    found = []
    if "@" in text:
        found += [("email", *span) for span in emails(text)]
    if DIGIT.search(text):
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(map(is_part, m[0].split(".")))]
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() < 38 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


def windows(text: str, longest: float = LONGEST, meet: bool = False) -> list[list[tuple[int, int]]]:
    """Spans of the words near digits, at signs and their spellings, in runs of bounded length.
    With ``meet``, the words before a run may be the last ones of the run before."""
    marks = [m.start() for m in SPARK.finditer(text)] if DIGIT.search(text) or "@" in text or "dot" in text.lower() else []
    out, done = [], -1
    for at in marks:
        if at < done:
            continue
        least = 0 if meet else max(done, 0)
        left = max(at - 100, least)
        while left > least and not text[left - 1].isspace():
            left -= 1
        before = [m.span() for m in WORD.finditer(text, left, at)]
        cut = before[-1][0] if before and before[-1][1] == at else at
        words = [w for w in before if w[1] <= cut or w[0] < cut][-AROUND:]
        words, quiet = [w for w in words if w[1] <= cut], 0
        for m in WORD.finditer(text, cut):
            words.append(m.span())
            quiet = 0 if SPARK.search(text, *m.span()) else quiet + 1
            if quiet >= AROUND or len(words) >= longest:
                break
        done = words[-1][1]
        out.append(words)
    return out


def views(text: str) -> list[tuple[list[tuple[int, int]], int, int]]:
    """Overlapping parts of the whole runs, and of each the first and last place where its spans begin.

    A part reaches ``MARGIN`` words beyond the places it answers for, on both sides.
    """
    out = []
    for run in windows(text, math.inf, True):
        for at in range(0, len(run), MARGIN):
            left = max(at - MARGIN, 0)
            out.append((run[left:at + 2 * MARGIN], at - left, min(at - left + MARGIN, len(run) - left)))
    return out


def shape(word: str) -> str:
    """Runs of letters as a, capitals A, digits d and their number; other signs stay."""
    short = word[:48]
    s = re.sub(r"[0-9]+", lambda m: f"d{min(len(m[0]), 6)}", re.sub(r"[^\W\d_A-Z]+", "a", re.sub(r"[A-Z]+", "A", short)))
    return s if len(word) <= 48 else s + "~"


def traits(words: list[str]) -> list[list[str]]:
    """Features of every word, from its own shape and its neighbours'."""
    shapes = [shape(w) for w in words]
    rough = [re.sub(r"d[0-9]", "d", s) for s in shapes]
    out = []
    for i, w in enumerate(words):
        n = len(DIGIT.findall(w))
        near = w.lower().strip("[](){}.,;:")
        out.append([
            "bias", f"s={shapes[i]}", f"r={rough[i]}", f"n={min(n, 20)}", f"@={w.count('@')}", f".={min(w.count('.'), 4)}",
            f"-={min(w.count('-'), 4)}", f"+={w[:1] == '+'}", f"l={min(len(w) // 4, 8)}",
            f"w={near}" if near in ("at", "dot", "phone", "tel", "call", "card", "ip", "mail", "email", "version", "license") else "w",
            f"<{rough[i - 1]}" if i else "<", f">{rough[i + 1]}" if i + 1 < len(words) else ">",
            f"<<{rough[i - 2]}" if i > 1 else "<<", f">>{rough[i + 2]}" if i + 2 < len(words) else ">>",
            f"<w={words[i - 1].lower() if i and words[i - 1].lower().strip('[](){}') in ('at', 'dot') else ''}",
            f">w={words[i + 1].lower() if i + 1 < len(words) and words[i + 1].lower().strip('[](){}') in ('at', 'dot') else ''}"])
    return out


def labelled(words: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    out = []
    for a, b in words:
        label = 0
        for kind, s, e in spans:
            if a < e and s < b:
                label = LABELS.index(("B-" if a <= s else "I-") + kind)
                break
        out.append(label)
    return out


def made_up() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Lines with spans in spellings that the fixed patterns miss, and lookalikes without any."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(["an", "ter", "lo", "mi", "sh", "en", "qua", "ro"]) for _ in range(rng.randint(1, 3)))
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    spelled = [
        ("phone", lambda: f"({number(3)}) {number(3)}-{number(4)}"), ("phone", lambda: f"{number(3)}-{number(3)}-{number(4)}"),
        ("phone", lambda: f"{number(3)}.{number(3)}.{number(4)}"), ("phone", lambda: f"00{number(2)} {number(3)} {number(7)}"),
        ("email", lambda: f"{word()} at {word()} dot com"), ("email", lambda: f"{word()}.{word()} [at] {word()} [dot] org"),
        ("email", lambda: f"{word()} (at) {word()} (dot) net"), ("email", lambda: f"{word()}{number(2)}@{word()}"),
        ("card", lambda: f"{number(4)}.{number(4)}.{number(4)}.{number(4)}"), ("card", lambda: f"{number(4)}/{number(4)}/{number(4)}/{number(4)}"),
        ("ip", lambda: f"{rng.randint(1, 255)}[.]{rng.randint(0, 255)}[.]{rng.randint(0, 255)}[.]{rng.randint(0, 255)}")]
    plain = [lambda: f"version {number(1)}.{number(1)}", lambda: f"License, Version {number(1)}.0.", lambda: f"in {rng.randint(1900, 2030)}",
             lambda: f"{number(2)}:{number(2)}", lambda: f"{rng.randint(1990, 2030)}-{number(2)}-{number(2)}", lambda: f"{number(3)},{number(3)}",
             lambda: f"at {word()}", lambda: f"at the dot {word()}", lambda: f"token = \"{hashlib.sha1(number(9).encode()).hexdigest()}\"",
             lambda: f"password={hashlib.sha1(number(9).encode()).hexdigest()[:18]}", lambda: f"{number(rng.randint(1, 6))}",
             lambda: f"{number(rng.randint(1, 5))}.{number(2)}", lambda: f"@{word()}", lambda: f"AKIA{number(4)}XYZ{number(3)}"]
    rows = []
    for i in range(EXAMPLES):
        before, after = " ".join(word() for _ in range(rng.randint(1, 5))), " ".join(word() for _ in range(rng.randint(1, 5)))
        if i % 2:
            kind, make = spelled[i // 2 % len(spelled)]
            value = make()
            rows.append((f"{before} {value}{rng.choice(['', ',', '.'])} {after}", [(kind, len(before) + 1, len(before) + 1 + len(value))]))
        else:
            rows.append((f"{before} {plain[i // 2 % len(plain)]()} {after}", []))
    for i in range(CASED):   # spelled emails again, in capitals or with a capital for each word
        before, value, after = word(), spelled[4 + i % 3][1](), word()
        other = [str.upper, str.title][i // 3 % 2]
        rows.append((other(f"{before} {value} {after}"), [("email", len(before) + 1, len(before) + 1 + len(value))]))
        rows.append((other(f"{before} at {after} {word()}"), []))
    return rows


class Tagger:
    """Feature names, weights, and spans of texts."""

    def __init__(self, names: dict[str, int], chain: Chain):
        self.names, self.chain = names, chain

    @classmethod
    def fit(cls, table: list[tuple[list[str], list[int]]]) -> "Tagger":
        """``table``: words and labels of each row."""
        rows = [(traits(w), y) for w, y in table if w]
        seen: dict[str, int] = {}
        for x, _ in rows:
            for f in x:
                for name in f:
                    seen[name] = seen.get(name, 0) + 1
        names = {f: i for i, f in enumerate(sorted(f for f, c in seen.items() if c > 1))}
        n = len(LABELS)
        allowed = np.ones((n + 1, n), bool)
        for i in range(2, n, 2):   # an inner label follows the first or an inner one of its kind
            allowed[:, i] = False
            allowed[[i - 1, i], i] = True
        chain = Chain(len(names), allowed)
        features, sizes = padded([[[names[f] for f in fs if f in names] for fs in x] for x, _ in rows])
        labels = np.zeros(features.shape[:2], np.int64)
        for i, (_, y) in enumerate(rows):
            labels[i, :len(y)] = y
        return cls(names, chain.fit(features, sizes, labels))

    def label(self, lines: list[list[str]]) -> list[list[int]]:
        """Labels of each list of words, decoded in batches."""
        out: list[list[int]] = [[] for _ in lines]
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))   # like lengths together, as all are padded to the longest
        for at in range(0, len(lines), 2048):
            some = order[at:at + 2048]
            features, sizes = padded([[[self.names[f] for f in fs if f in self.names] for fs in traits(lines[i])] for i in some])
            for i, row, n in zip(some, self.chain.decode(features, sizes).tolist(), sizes.tolist()):
                out[i] = row[:n]
        return out

    def added(self, texts: list[str], bases: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
        """Spans of the field that meet no base span."""
        jobs = [(i, *v) for i, t in enumerate(texts) for v in views(t)]
        labels = self.label([[texts[i][a:b] for a, b in w] for i, w, _, _ in jobs])
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        done = [0] * len(texts)   # end of the last span, as the next part may begin one inside it
        for (i, words, first, last), row in zip(jobs, labels):
            at = 0
            while at < len(row):
                if row[at] == 0:
                    at += 1
                    continue
                stop = at + 1
                while stop < len(row) and row[stop] == row[at] + 1:
                    stop += 1
                if not first <= at < last or words[at][0] < done[i]:
                    at = stop
                    continue
                kind, done[i] = LABELS[row[at]][2:], words[stop - 1][1]
                span = trimmed(texts[i], kind, words[at][0], words[stop - 1][1])
                if span and not any(s < span[2] and span[1] < e for _, s, e in bases[i]):
                    out[i].append(span)
                at = stop
        return out


def trimmed(text: str, kind: str, start: int, end: int) -> tuple[str, int, int] | None:
    """The span without signs around it, if it has what its kind needs."""
    keep = (lambda c: c.isalnum() or c in "([+") if kind == "phone" else str.isalnum
    while start < end and not keep(text[start]):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    value = text[start:end]
    n = len(DIGIT.findall(value))
    fits = {"phone": 7 <= n <= 15, "card": 13 <= n <= 19 and luhn(digits_of(value)),
            "ip": len(parts := re.findall("[0-9]{1,3}", value)) == 4 and all(int(p) <= 255 for p in parts),
            "email": len(value) <= LONGEST_EMAIL and SPELLED.fullmatch(value) is not None}[kind]
    return (kind, start, end) if fits and start < end else None


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def sample_table(docs: DataFrame, size: int = SAMPLE) -> list[tuple[list[str], list[int]]]:
    """Words and labels of the ``size`` windows of the corpus that come first by hash."""
    def run(batches):
        for batch in batches:
            words, labels = [], []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for w in windows(text):
                    words.append([text[a:b][:200] for a, b in w])
                    labels.append(labelled(w, spans))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int32()))], names=["words", "labels"])

    rows = docs.select(text_of().alias("_text")).mapInArrow(run, "words array<string>, labels array<int>")
    # Merged in a task and written, so that the driver gets ``size`` rows and not those of every task.
    first = stage(rows.select("words", "labels", F.xxhash64("words").alias("h")).orderBy("h", "words").limit(size), "windows").collect()
    return [(r["words"], r["labels"]) for r in first]


def trained(docs: DataFrame) -> Tagger:
    """The field of a corpus. What the patterns don't label isn't always plain text: windows in which
    the made-up lines alone suggest a span beside the patterns' don't go into the table."""
    own = []
    for text, spans in made_up():
        own += [([text[a:b] for a, b in w], labelled(w, spans)) for w in windows(text)]
    first, sampled = Tagger.fit(own), sample_table(docs)
    guesses = first.label([w for w, _ in sampled])
    sure = [row for row, guess in zip(sampled, guesses) if all(y or not g for y, g in zip(row[1], guess))]
    return Tagger.fit(sure + own)


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the patterns' spans, their digest, and ``spans`` of patterns and field together."""
    tagger = docs.sparkSession.sparkContext.broadcast(trained(docs))

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            bases = [base_spans(t) for t in texts]
            more = tagger.value.added(texts, bases)
            counts = [[sum(k == kind for k, _, _ in b) for b in bases] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in bases]),
                 pa.array([joined(b + m) for b, m in zip(bases, more)])],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), text_of().alias("_text")).mapInArrow(
        run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
