"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios under a linear hinge loss.

A text is the set of its hashed 1-grams and 2-grams of tokens: lower-cased letter runs, digit runs (their length
only), punctuation runs, and a mark for words in capitals. The indicator of a feature is scaled by its log-count ratio
between the classes, each text is scaled to unit length, and the weights come from dual coordinate descent
(L2-regularised hinge loss). The margin becomes a probability by a logistic curve fitted on labelled rows held back
from the fit.

The fit takes at most `max_rows` labelled rows, those with the smallest hashes of their id (a bounded sample, so it
runs in one task whatever the corpus); everything else covers all rows. Scoring is a map over the scan: the model is
one vector of `2 ** bits` floats.

Defined results: null and empty texts have no feature and get the probability of the bias; rows with null labels or
ids do not teach; an id labelled twice is good only if all its labels are; repeated rows are scored alike; with no
labelled rows, or one class only, the share of good rows (or 0.5) is everyone's score; an empty table gives none;
columns of the input are kept and `score` must be a new name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.llm.common import col, fresh, release_memory, ship_package, slices, texts

BITS = 20
MAX_ROWS = 20_000
CALIBRATION_SHARE = 4  # one row in four teaches the curve, not the weights
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
CACHE = 300_000
#: Texts whose features are counted at once.
COUNTED = 256

_TOKEN = re.compile(r"([^\W\d_]+)|(\d+)|([^\w\s]+|_+)")
_cache: dict[str, bytes] = {}


def _tokens(chunk: str) -> bytes:
    """32-bit token hashes of a chunk without white space."""
    out = []
    for word, digits, marks in _TOKEN.findall(chunk):
        if word:
            out.append("w" + word.lower())
            if len(word) > 1 and word.isupper():
                out.append("^")
        else:
            out.append(f"d{len(digits)}" if digits else "p" + marks[:8])
    return np.array([zlib.crc32(x.encode()) for x in out], "<u4").tobytes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x >> np.uint64(32)


def features(values: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) pairs of some texts, sorted."""
    rows, hashes = [], []
    for i, text in enumerate(values):
        parts = []
        for chunk in text.split():
            found = _cache.get(chunk)
            if found is None:
                found = _tokens(chunk)
                if len(_cache) < CACHE:
                    _cache[chunk] = found
            parts.append(found)
        h = np.frombuffer(b"".join(parts), "<u4")
        hashes.append(h)
        rows.append(np.full(len(h), i, np.uint64))
    if not hashes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    h, row = np.concatenate(hashes).astype(np.uint64), np.concatenate(rows)
    same = row[1:] == row[:-1]
    pairs = _mix((h[:-1] << np.uint64(32) | h[1:])[same] + np.uint64(1))
    mask = np.uint64((1 << bits) - 1)
    keys = np.concatenate([row << np.uint64(bits) | _mix(h) & mask, row[1:][same] << np.uint64(bits) | pairs & mask])
    keys = np.unique(keys)
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & mask).astype(np.int64)


def margins(values: list[str], weights: np.ndarray, ratio: np.ndarray, bias: float, bits: int = BITS) -> np.ndarray:
    row, feature = features(values, bits)
    r = ratio[feature]
    dot = np.bincount(row, weights=weights[feature] * r, minlength=len(values))
    norm = np.sqrt(np.bincount(row, weights=r * r, minlength=len(values)))
    return dot / np.maximum(norm, 1e-12) + bias


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, size: int, smoothing: float = SMOOTHING) -> np.ndarray:
    """ln of the smoothed share of a feature among good texts' indicators over that among bad ones'."""
    counts = []
    for side in (1, -1):
        own = [f for f, label in zip(rows, y) if label == side]
        n = np.zeros(size)
        for start in range(0, len(own), COUNTED):
            n += np.bincount(np.concatenate(own[start : start + COUNTED]), minlength=size)
        n += smoothing
        counts.append(n / n.sum())
    return np.log(counts[0] / counts[1])


def dual_coordinate_descent(
    rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS, seed: int = 7,
) -> tuple[np.ndarray, float]:
    """Weights and bias minimising |w|^2 / 2 + sum cost * max(0, 1 - y (w.x + b)); x of unit length, bias as a feature.

    x is made again at each visit: kept, it would be twice the size of `rows`.
    """
    length = np.array([max(float(np.sqrt((r := ratio[f]) @ r)), 1e-12) for f in rows])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    square = np.array([float((v := ratio[f] / length[i]) @ v) + 1.0 for i, f in enumerate(rows)])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        change = 0.0
        for i in order.permutation(len(rows)):
            f = rows[i]
            v = ratio[f] / length[i]
            slope = y[i] * (w[f] @ v + bias) - 1.0
            step = min(max(alpha[i] - slope / square[i], 0.0), cost[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[f] += step * y[i] * v
                bias += step * y[i]
                change = max(change, abs(step))
        if change < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, good: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a, b of P(good) = 1 / (1 + exp(-(a m + b))): Newton steps with softened targets."""
    n1, n0 = float(good.sum()), float(len(good) - good.sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        ga, gb = float(g @ margin), float(g.sum())
        haa, hab, hbb = float(h @ (margin * margin)) + 1e-6, float(h @ margin), float(h.sum()) + 1e-6
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(abs(da), abs(db))
        shrink = min(1.0, 5.0 / size) if size else 1.0
        a, b = a - shrink * da, b - shrink * db
        if size < 1e-8:
            break
    return a, b


def fit_rows(ids: list, labels: list[int], rows: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, float, float, float]:
    """weights, ratio, bias, a, b."""
    size = 1 << bits
    y = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    back = np.array([zlib.crc32(f"hold {x}".encode()) % CALIBRATION_SHARE == 0 for x in ids], bool)
    zero = np.zeros(size)
    share = float((y == 1).mean()) if len(y) else 0.5
    if len(set(y[~back])) < 2:
        return zero, zero, 0.0, 0.0, float(np.log((share * len(y) + 1) / ((1 - share) * len(y) + 1)))
    taught = [f for f, held in zip(rows, back) if not held]
    ratio = log_count_ratio(taught, y[~back], size)
    # both classes weigh the same, so the margin says which class a text is like, and the curve how many there are
    own = y[~back]
    cost = COST * np.where(own == 1, len(own) / (2 * (own == 1).sum()), len(own) / (2 * (own == -1).sum()))
    w, bias = dual_coordinate_descent(taught, own, ratio, cost)
    curve = [(f, label) for f, label, held in zip(rows, y, back) if held]
    if len({label for _, label in curve}) < 2:
        curve = [(f, label) for f, label in zip(rows, y)]
    m = np.array([float((w[f] * ratio[f]).sum()) / max(float(np.sqrt(ratio[f] @ ratio[f])), 1e-12) + bias for f, _ in curve])
    a, b = logistic_curve(m, np.array([label == 1 for _, label in curve]))
    return w, ratio, bias, a, b


def training_rows(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS, bits: int = BITS,
) -> DataFrame:
    """`id, y, f` of at most `max_rows` labelled documents, one for each id and text, in a fixed order of their hashes."""
    ship_package(docs.sparkSession)
    key = fresh("label__id", docs.columns)
    taught = labels.where(col(label).isNotNull() & col(id_column).isNotNull()).groupBy(col(id_column).alias(key)).agg(F.min(col(label)).alias("y"))
    taught = taught.orderBy(F.xxhash64(F.lit(17), col(key)), col(key)).limit(max_rows)
    # at most max_rows pairs of numbers, whatever the size of the corpus
    rows = docs.select(col(id_column).alias("id"), col(text).cast("string").alias("text")).join(F.broadcast(taught), F.col("id") == col(key)).select("id", "text", "y")

    def extract(batches: Iterable[pa.RecordBatch]):
        for part in slices(batches):
            row, feature = features(texts(part.column(1)), bits)
            ends = np.searchsorted(row, np.arange(part.num_rows + 1))
            yield pa.record_batch({
                "id": part.column(0).cast(pa.string()), "y": part.column(2).cast(pa.int32()), "h": part.column(3),
                "f": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature, pa.int32())),
            })

    found = rows.withColumn("h", F.xxhash64("text")).mapInArrow(extract, "id string, y int, h long, f array<int>")
    # copies of a row, however many, are one
    one = found.groupBy("id", "h").agg(F.first("y").alias("y"), F.first("f").alias("f"))
    return one.orderBy(F.xxhash64(F.lit(17), F.col("id")), "id", "h").limit(max_rows).select("id", "y", "f")


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_ROWS, bits: int = BITS,
) -> dict:
    """The model as a small dictionary, from at most `max_rows` rows. Only ids, texts and the given labels are read."""

    def train(batches: Iterable[pa.RecordBatch]):
        ids, y, rows = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
            rows += [np.asarray(x.values) if x.is_valid else np.empty(0, np.int32) for x in batch.column(2)]
        times = Counter(ids)
        order = sorted(range(len(ids)), key=lambda i: (ids[i], y[i], rows[i].tobytes() if times[ids[i]] > 1 else b""))
        w, ratio, bias, a, b = fit_rows([ids[i] for i in order], [y[i] for i in order], [rows[i] for i in order], bits)
        rows.clear()
        batch = None
        release_memory()
        yield pa.record_batch({
            "weights": pa.array([w.astype("<f4").tobytes()], pa.binary()), "ratio": pa.array([ratio.astype("<f4").tobytes()], pa.binary()),
            "curve": pa.array([[float(bias), float(a), float(b)]], pa.list_(pa.float64())),
        })

    sample = training_rows(docs, labels, id_column, text, label, max_rows, bits)
    model = sample.mapInArrow(train, "weights binary, ratio binary, curve array<double>").collect()
    if not model:
        return {"weights": np.zeros(1 << bits, "<f4").tobytes(), "ratio": np.zeros(1 << bits, "<f4").tobytes(), "curve": [0.0, 0.0, 0.0], "bits": bits}
    return {"weights": bytes(model[0].weights), "ratio": bytes(model[0].ratio), "curve": list(model[0].curve), "bits": bits}


def score(docs: DataFrame, model: dict, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the probability of label 1."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]):
        m = shared.value
        w, ratio = np.frombuffer(m["weights"], "<f4").astype("f8"), np.frombuffer(m["ratio"], "<f4").astype("f8")
        bias, a, b = m["curve"]
        for part in slices(batches):
            at = margins(texts(part.column(part.num_columns - 1)), w, ratio, bias, m["bits"])
            p = 1 / (1 + np.exp(-np.clip(a * at + b, -30, 30)))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(p)], schema=pa.schema([*list(part.schema)[:-1], pa.field(name, pa.float64())]))
        release_memory()

    own = fresh("text__", [*docs.columns, name])
    schema = docs.select(*[col(c) for c in docs.columns]).withColumn(name, F.lit(0.0)).schema
    return docs.withColumn(own, col(text).cast("string")).mapInArrow(run, schema)
