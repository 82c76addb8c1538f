"""Operator 4: quality classifier by Naive Bayes support vectors (NBSVM).

Features are n-gram indicators of a text in a fixed space of ``2 * HALF`` hashed places: byte
1- to 3-grams, and 1- to 5-grams of word forms (a word's first and last character class, whether
it is upper-case, and whether it repeats the word one or two places before).  Each indicator is scaled by
its class log-count ratio, counted in Spark over a bounded sample of the labelled training rows
(``RATIO_ROWS`` a class, those of smallest hash).  A linear
hinge-loss model is then fitted by dual coordinate descent on a bounded sample of the training
rows (``SAMPLE_ROWS`` a class, those of smallest hash), interpolated with the mean weight, and
calibrated by a logistic curve on a part of the sample that the fit didn't see.

Edge cases.  Null and empty texts have no indicators and get the calibrated bias.  Labels that are
null, and rows whose doc_id is null, teach nothing.  A doc_id labelled repeatedly teaches once per
label row.  Without labels of both classes the score is the smoothed share of label 1 everywhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, byte_slices, mix64, word_hashes, word_spans

HALF = 1 << 15
#: Labelled rows of each class that the log-count ratios and the hinge-loss fit may use.
RATIO_ROWS, SAMPLE_ROWS = 20_000, 3000
THRESHOLD = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def indicators(texts: list[bytes]) -> np.ndarray:
    """A 0/1 matrix, a row per text and a column per hashed n-gram."""
    out = np.zeros((len(texts), 2 * HALF), np.uint8)
    b, start, end, doc = word_spans(texts)
    at = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    wide = b.astype(np.uint32)
    code = np.zeros(len(b), np.uint32)
    for n in range(1, 4):
        code = code[:len(b) - n + 1] * np.uint32(256) + wide[n - 1:]
        inside = at[:len(code)] == at[n - 1:]
        place = (code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(17)
        out[at[:len(code)][inside], place[inside]] = 1
    if len(start):
        kind = np.full(256, 4, np.uint64)  # other bytes, those of longer sequences among them
        kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
        kind[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 3  # usual punctuation
        kind[128:] = 5
        h = word_hashes(b, start, end)
        again = np.zeros(len(h), np.uint64)
        for back in (2, 1):
            same = (h[back:] == h[:-back]) & (doc[back:] == doc[:-back]) if len(h) > back else np.zeros(0, bool)
            again[back:][same] = back
        lower = np.concatenate([[0], np.cumsum((b >= 97) & (b <= 122))])
        upper = np.concatenate([[0], np.cumsum((b >= 65) & (b <= 90))])
        shout = ((upper[end] - upper[start] > 1) & (lower[end] == lower[start])).astype(np.uint64)
        form = ((again * np.uint64(6) + kind[b[start]]) * np.uint64(6) + kind[b[end - 1]]) * np.uint64(2) + shout
        code = np.zeros(len(form), np.uint64)
        for n in range(1, 6):
            code = code[:len(form) - n + 1] * np.uint64(217) + form[n - 1:] + np.uint64(1)
            inside = doc[:len(code)] == doc[n - 1:]
            place = mix64(code + np.uint64(n << 56)) & np.uint64(HALF - 1)
            out[doc[:len(code)][inside], HALF + place[inside].astype(np.int64)] = 1
            if len(code) < 2:
                break
    return out


def _bytes(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def class_counts(rows: DataFrame) -> DataFrame:
    """(place, n1, n0): training rows of either label that have the indicator; place -1 counts all."""
    def run(batches):
        total = np.zeros((2, 2 * HALF + 1), np.int64)
        for batch in batches:
            texts, label = _bytes(batch.column(0)), np.array(batch.column(1).to_pylist(), np.int64)
            for lo, hi in byte_slices(texts):
                x = indicators(texts[lo:hi])
                for c in (0, 1):
                    total[c, :-1] += x[label[lo:hi] == c].sum(axis=0, dtype=np.int64)
                    total[c, -1] += (label[lo:hi] == c).sum()
        place = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.where(place == 2 * HALF, -1, place)),
                                          pa.array(total[1, place]), pa.array(total[0, place])], names=["place", "n1", "n0"])

    return bounded(rows).select("text", "label").mapInArrow(run, "place bigint, n1 bigint, n0 bigint").groupBy("place").agg(
        F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _sparse(rows: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts, found = _bytes(batch.column(0)), []
            for lo, hi in byte_slices(texts):
                found += [np.flatnonzero(x).astype("<u4").tobytes() for x in indicators(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], names=["places", "label"])

    return bounded(rows).select("text", "label").mapInArrow(run, "places binary, label int")


def dual_descent(x: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 20,
                 seed: int = 7) -> np.ndarray:
    """Weights (bias last) of the linear hinge-loss model on scaled, unit-length indicator rows.

    Dual coordinate descent: each step solves one row's dual variable exactly within [0, cost].
    """
    w, alpha, rng = np.zeros(len(scale) + 1), np.zeros(len(x)), np.random.default_rng(seed)
    rows = []
    for places in x:
        v = scale[places]
        rows.append((np.append(places, len(scale)), np.append(v / max(np.linalg.norm(v), 1e-9), 1.0)))
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            places, v = rows[i]
            gradient = y[i] * (w[places] @ v) - 1
            new = min(max(alpha[i] - gradient / (v @ v), 0.0), cost[i])
            if new != alpha[i]:
                w[places] += (new - alpha[i]) * y[i] * v
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibrate(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, by weighted Newton steps with smoothed targets."""
    n1, n0 = weight[label == 1].sum(), weight[label == 0].sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, float(np.log((n1 + 1) / (n0 + 1)))
    z = np.stack([margin, np.ones(len(margin))], axis=1)
    for _ in range(50):
        p = _logistic(z @ [slope, offset])
        curve = z.T @ (z * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, z.T @ (weight * (target - p)) - 1e-3 * np.array([slope, 0]))
        step *= min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(slope), 0.0), float(offset)


class Model:
    """Weights by place, and the calibration.  Its size is fixed by the hashed space."""

    def __init__(self, scale=None, w=None, slope=0.0, offset=0.0):
        self.scale = np.zeros(2 * HALF, np.float32) if scale is None else scale.astype(np.float32)
        self.w = np.zeros(2 * HALF + 1, np.float32) if w is None else w.astype(np.float32)
        self.slope, self.offset = slope, offset

    def margins(self, x: np.ndarray) -> np.ndarray:
        seen = x.astype(np.float32)
        norm = np.sqrt(np.maximum(seen @ (self.scale * self.scale), 1e-18))
        return seen @ (self.scale * self.w[:-1]) / norm + self.w[-1]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for lo, hi in byte_slices(texts):
            out[lo:hi] = _logistic(self.slope * self.margins(indicators(texts[lo:hi])) + self.offset)
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", ratio_rows: int = RATIO_ROWS,
        sample_rows: int = SAMPLE_ROWS, cost: float = 10.0, beta: float = 0.25) -> Model:
    """Fit on labelled rows of ``docs`` that are not held out."""
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label).cast("int").alias("label"))
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model(offset=float(np.log((n1 + 1) / (n0 + 1))))

    def drawn(n: int) -> DataFrame:
        ids = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c in (0, 1)]
        return docs.select("doc_id", "text").join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")

    counts = class_counts(drawn(ratio_rows)).collect()  # a row per place of the fixed hashed space
    p, q = np.ones(2 * HALF), np.ones(2 * HALF)
    for r in counts:
        if r.place >= 0:
            p[r.place] += r.n1
            q[r.place] += r.n0
    scale = np.log(p / p.sum()) - np.log(q / q.sum())
    scale[(p == 1) & (q == 1)] = 0
    sample = sorted(_sparse(drawn(sample_rows)).collect())  # the order of arrival must not matter
    x = [np.frombuffer(r.places, "<u4") for r in sample]
    y = np.array([r.label for r in sample])
    take = {c: int((y == c).sum()) for c in (0, 1)}
    if not all(take.values()):
        return Model(offset=float(np.log((n1 + 1) / (n0 + 1))))
    weight = np.where(y == 1, n1 / take[1], n0 / take[0])  # back to the shares of all training rows
    turn = np.zeros(len(y), np.int64)
    for c in (0, 1):
        turn[y == c] = np.arange(take[c])
    unseen = turn % 5 == 4
    costs = cost * len(y) / (2 * np.where(y == 1, take[1], take[0]))
    sign = np.where(y == 1, 1, -1)

    def learn(use):
        w = dual_descent([x[i] for i in np.flatnonzero(use)], scale, sign[use], costs[use])
        return np.append((1 - beta) * np.abs(w[:-1]).mean() * np.sign(w[:-1]) + beta * w[:-1], beta * w[-1]) \
            if beta < 1 else w

    part = Model(scale, learn(~unseen))
    use = unseen if len(set(y[unseen])) == 2 else np.ones(len(y), bool)
    rows_of = np.flatnonzero(use)
    margin = np.array([part.w[-1] + (scale[x[i]] * part.w[x[i]]).sum() / max(np.linalg.norm(scale[x[i]]), 1e-9)
                       for i in rows_of])
    spread = max(margin.std(), 1e-9)
    slope, offset = calibrate(margin / spread, y[use], weight[use])
    return Model(scale, part.w, slope / spread, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_bytes(batch.column(1))))],
                                             names=["doc_id", "score"])

    return bounded(docs).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of ``threshold`` at least, all columns kept."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.scores(_bytes(batch.column(at))) >= threshold))

    return bounded(docs).mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
