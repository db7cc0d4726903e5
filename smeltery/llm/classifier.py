"""A quality classifier: naive Bayes features for a support vector machine.

Texts become indicators of hashed n-grams (``grams``). Each indicator is scaled by the log ratio of its smoothed
shares among the documents of either class, counted over every labelled document to learn from; each task sums its
counts before the shuffle, and the table has a row for each feature. A linear machine with hinge loss is then fitted
to the scaled indicators (of length one) by dual coordinate descent, on a sample of at most ``SAMPLE`` documents: those
first by a hash of the id. Margins of at most ``CALIBRATION`` other documents fit the sigmoid that makes a margin a
share, so a score of 0.3 means what it says.

Ids decide the parts, by their checksum modulo five: 0 is held out, 1 calibrates, the others teach. Scores see the
text alone. Null text counts as empty and has a score like any other. Null ids are in no part. A document with both
labels counts once for each; labels other than 0 and 1 count for none; repeated rows count each. If the labels to learn
from know one class only, or there are none, every score is the smoothed share of class 1. An empty table gives an
empty result. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from smeltery.llm.common import slices, text_of
from smeltery.llm.grams import BITS, Indicators
from smeltery.session import stage

PARTS = 5
SAMPLE = 8000        # documents that the machine is fitted to
CALIBRATION = 4000   # documents that the sigmoid is fitted to
SMOOTHING = 1.0
COST = 1.0           # of a unit of hinge loss
EPOCHS = 40
CUTOFF = 0.3
BROADCAST_ROWS = 1_000_000   # labels sent to every task
SLICE = 4_000_000    # bytes of texts held as Python strings at a time


@dataclass(frozen=True)
class Model:
    """``scaled``: weight times ratio of each feature, ``square``: of the ratio."""

    scaled: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        size = float(np.sqrt(self.square[found].sum()))
        return (float(self.scaled[found].sum()) / size if size else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(sigmoid(self.slope * self.margin(found) + self.shift))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


def part_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % PARTS


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``y`` and ``text`` of the documents to learn from; none that is held out.

    Up to ``BROADCAST_ROWS`` labels (three numbers each) go to the texts, which then don't move. More labels and
    the texts meet in one shuffle, and the labelled texts are written once for all that read them.
    """
    marks = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    marks = marks.where(F.col("y").isin(0, 1)).distinct().withColumn("part", part_of(F.col("doc_id"))).where("part > 0")
    marks = stage(marks, "labels")
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    few = marks.count() <= BROADCAST_ROWS
    rows = own.join(F.broadcast(marks) if few else marks, "doc_id").select("doc_id", "part", "y", "text")
    return rows if few else stage(rows, "labelled")


def counts(rows: DataFrame) -> np.ndarray:
    """How many documents of each class hold each feature; in the last column, how many there are."""
    def run(batches):
        total, own = np.zeros((2, (1 << BITS) + 1), np.int64), Indicators()
        for batch in batches:
            for part in slices(batch, 1, SLICE):
                for y, found in zip(part.column(0).to_pylist(), own.of(part.column(1).to_pylist())):
                    total[y, found] += 1
                    total[y, -1] += 1
        at = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["feature", "n0", "n1"])

    each = rows.select("y", "text").mapInArrow(run, "feature bigint, n0 bigint, n1 bigint")
    table = each.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()  # a row for each feature
    out = np.zeros((2, (1 << BITS) + 1))
    for y in (0, 1):
        out[y, table["feature"].to_numpy()] = table[f"n{y}"].to_numpy()
    return out


def ratios(n: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of a feature's shares in class 1 and class 0."""
    share = (n[:, :-1] + smoothing) / (n[:, -1:] + 2 * smoothing)
    return np.log(share[1]) - np.log(share[0])


def sample(rows: DataFrame, size: int) -> list[tuple[int, np.ndarray]]:
    """Labels and features of the ``size`` rows that come first by a hash of the id."""
    mark = F.xxhash64("doc_id", F.lit(3))
    marked = rows.select(mark.alias("mark"), "doc_id", "y", "text")
    # The bound from two narrow columns first, so that few texts are turned into features.
    last = marked.select("mark").orderBy("mark").limit(size).agg(F.max("mark")).first()[0]
    if last is None:
        return []

    def run(batches):
        own = Indicators()
        for batch in batches:
            for part in slices(batch, 3, SLICE):
                found = [f.astype("<u2").tobytes() for f in own.of(part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(found, pa.binary())], names=["mark", "doc_id", "y", "found"])

    few = marked.where(F.col("mark") <= last).mapInArrow(run, "mark bigint, doc_id bigint, y int, found binary")
    first = few.orderBy("mark", "doc_id", "y", "found").limit(size).toArrow()
    return [(y, np.frombuffer(f, "<u2")) for y, f in zip(first["y"].to_pylist(), first["found"].to_pylist())]


def descend(rows: list[tuple[int, np.ndarray]], ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS,
            least: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and dual variables of the machine: one variable at a time is set to its best value."""
    weight, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    units, norms = [], []
    for _, found in rows:
        v = ratio[found]
        size = np.linalg.norm(v)
        units.append(v / size if size else v)
        norms.append(1.0 + float(size > 0))   # of the vector and of the bias's constant
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        worst = 0.0
        for k in rng.permutation(len(rows)).tolist():
            y, found = rows[k]
            sign, v, old = 2 * y - 1, units[k], dual[k]
            slope = sign * (float(weight[found] @ v) + bias) - 1.0
            worst = max(worst, abs(min(slope, 0.0) if old == 0 else max(slope, 0.0) if old == cost else slope))
            dual[k] = min(max(old - slope / norms[k], 0.0), cost)
            if step := (dual[k] - old) * sign:
                weight[found] += step * v
                bias += step
        if worst < least:
            break
    return weight, bias, dual


def calibrated(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid with the best likelihood, towards smoothed targets, by damped Newton steps."""
    n1 = int(y.sum())
    n0 = len(y) - n1
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(y))])
    ab = np.array([0.0, np.log((n1 + 1) / (n0 + 1))])

    def loss(ab):
        z = x @ ab
        return float((np.logaddexp(0, z) - target * z).sum())

    for _ in range(100):
        p = sigmoid(x @ ab)
        gradient = x.T @ (p - target)
        if np.abs(gradient).max() < 1e-9 * len(y):
            break
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), gradient)
        scale = 1.0
        while scale > 1e-6 and loss(ab - scale * step) > loss(ab):
            scale /= 2
        ab = ab - scale * step
    return float(ab[0]), float(ab[1])


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    rows = labelled(docs, labels)
    teach = rows.where("part > 1")
    n = counts(teach)
    flat = np.zeros(1 << BITS)
    if not n[:, -1].all():
        n0, n1 = n[:, -1]
        return Model(flat, flat, 0.0, 0.0, float(np.log((n1 + 1) / (n0 + 1))))
    ratio = ratios(n)
    weight, bias, _ = descend(sample(teach, SAMPLE), ratio)
    model = Model(weight * ratio, ratio ** 2, bias, 1.0, 0.0)
    apart = sample(rows.where("part = 1"), CALIBRATION)
    y = np.array([y for y, _ in apart], np.int64)
    if not 0 < y.sum() < len(y):
        return model
    slope, shift = calibrated(np.array([model.margin(f) for _, f in apart]), y)
    return Model(model.scaled, model.square, bias, max(slope, 0.0), shift)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # two numbers for each feature

    def run(batches):
        own = Indicators()
        for batch in batches:
            for part in slices(batch, 2, SLICE):
                got = pa.array([shared.value.score(f) for f in own.of(part.column(2).to_pylist())], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns[:2], got], names=["doc_id", "held_out", "score"])

    held = F.coalesce(part_of(F.col("doc_id")) == 0, F.lit(False))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held.alias("held_out"), text_of().alias("text"))
    got = own.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return got.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scores(docs, fitted(docs, labels))
