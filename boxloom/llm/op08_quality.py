"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

Features are indicators of byte trigrams, of n-grams over character classes (runs of capitals, small letters,
digits, marks and spaces), and of bigrams of equal words, hashed into `BUCKETS` places. Each is scaled by its class
log-count ratio (naive Bayes), then a linear hinge-loss model is fitted by dual coordinate descent and
interpolated with the naive Bayes weights. A logistic curve fitted on left-out training rows turns margins into
scores.

The model is fitted on a bounded sample: the `TRAINING_ROWS` labelled rows that come first by a hash of doc_id, among
those whose crc32(doc_id as text) mod 3 is not 1; the rest is held out. Only texts enter features. Scoring covers
every whole text and is a map: the weights have a fixed size.

Null and empty texts have no features and get the score of the bias alone. Null labels are skipped; a repeated label
counts repeatedly. Without labels of both kinds every score is 0.5 and every document is kept. Repeated rows
are scored alike. Other columns are ignored by `score` and passed on by `keep_good`. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 18
TRAINING_ROWS = 6000
EPOCHS, COST, SMOOTHING, BLEND = 12, 1.0, 1.0, 0.25

_CLASS = np.zeros(256, np.uint8)
for _bytes, _kind in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"abcdefghijklmnopqrstuvwxyz", 2), (b"0123456789", 3), (b" ", 4), (b"\n", 5), (b"\t\r\x0b\x0c", 6)):
    _CLASS[list(_bytes)] = _kind
for _mark in range(33, 127):
    if not _CLASS[_mark]:
        _CLASS[_mark] = _mark + 10
_CLASS[128:] = 2


def features(text: str | None) -> np.ndarray:
    """The places of a text's n-grams, each once."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, np.uint8)
    found = []
    if len(raw) >= 3:
        wide = raw.astype(np.uint32)
        found.append((wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761) >> np.uint32(14))
    kind = _CLASS[raw]
    kind = kind[np.r_[True, kind[1:] != kind[:-1]]].astype(np.uint32) if len(kind) else kind.astype(np.uint32)
    for n in (3, 5):
        if len(kind) >= n:
            h = np.full(len(kind) - n + 1, n, np.uint32)
            for i in range(n):
                h = (h ^ kind[i : len(kind) - n + 1 + i]) * np.uint32(16777619)
            found.append((h ^ h >> np.uint32(15)) * np.uint32(2654435761) >> np.uint32(14))
    words = data.split()
    equal = sum(a == b for a, b in zip(words, words[1:], strict=False))
    if equal:
        # how common bigrams of equal words are, in powers of two
        found.append(np.array([BUCKETS - 1 - min(10, int(np.log2(len(words) / equal)))], np.uint32))
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.zeros(0, np.int32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, places: np.ndarray) -> float:
        margin = self.bias + float(self.weights[places].sum()) / max(1.0, len(places)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def _descend(rows: list[np.ndarray], ratio: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L1-loss support vector machine, bias as a constant feature."""
    values = [ratio[r] / max(1.0, len(r)) ** 0.5 for r in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    balance = COST * len(sign) / (2 * np.where(sign > 0, (sign > 0).sum(), (sign < 0).sum()))
    w, b, alpha, rng = np.zeros(BUCKETS, np.float64), 0.0, np.zeros(len(rows)), np.random.default_rng(3)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)).tolist():
            gradient = sign[i] * (float(w[rows[i]] @ values[i]) + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), balance[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[rows[i]] += step * values[i]
                b += step
                alpha[i] = new
    return w, b


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    sign = np.where(labels == 1, 1.0, -1.0)
    if len(rows) < 20 or abs(sign.sum()) == len(sign):
        return Model(np.zeros(BUCKETS), 0.0, 0.0, 0.0)

    def train(part: np.ndarray) -> tuple[np.ndarray, float]:
        counts = [np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)]
        for i in part.tolist():
            counts[int(sign[i] > 0)][rows[i]] += 1
        good, bad = counts[1] / ((sign[part] > 0).sum() + 2 * SMOOTHING), counts[0] / ((sign[part] < 0).sum() + 2 * SMOOTHING)
        ratio = np.log(good / bad)
        w, b = _descend([rows[i] for i in part], ratio, sign[part])
        return ((1 - BLEND) * np.abs(w).mean() + BLEND * w) * ratio, BLEND * b

    margin = lambda model, i: model[1] + float(model[0][rows[i]].sum()) / max(1.0, len(rows[i])) ** 0.5
    every = np.arange(len(rows))
    out, target = [], []
    for fold in range(3):
        inside, left = every[every % 3 != fold], every[every % 3 == fold]
        if len(set(sign[inside])) < 2:
            continue
        model = train(inside)
        out += [margin(model, i) for i in left]
        target += (sign[left] > 0).tolist()
    x, y = np.array(out), np.array(target, float)
    scale, slope, shift = x.std() or 1.0, 1.0, 0.0
    for _ in range(500):  # the logistic curve, both kinds weighing the same
        p = 1 / (1 + np.exp(-np.clip(slope * x / scale + shift, -30, 30)))
        error = (y - p) * np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
        slope, shift = slope + 2 * float(error @ (x / scale)), shift + 2 * float(error.sum())
    weights, bias = train(every)
    return Model(weights, bias, slope / scale, shift)


def held_out(column="doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded sample of labelled rows that are not held out."""
    chosen = (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where(~held_out())
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_ROWS)
    )
    chosen = chosen.sparkSession.createDataFrame(chosen.collect(), "doc_id long, quality int")  # at most TRAINING_ROWS rows

    def extract(batches):
        for batch in batches:
            rows = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32())), batch.column(2)], names=["doc_id", "places", "quality"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(extract, "doc_id long, places array<int>, quality int").toArrow()
    table = table.sort_by("doc_id")
    return fit([np.asarray(x.values) for x in table["places"]], table["quality"].to_numpy())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches):
        for batch in batches:
            scores = [shared.value.score(features(t.as_py())) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is at least one half, with all their columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def scan(batches):
        for batch in batches:
            yield batch.filter(pa.array([shared.value.score(features(t.as_py())) >= 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score(docs, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
