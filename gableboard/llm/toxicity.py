"""Toxicity by a bag of subword embeddings, averaged into a linear softmax.

A word is the mean of the embeddings of its character n-grams (3 to 5 bytes, with its borders) and of the
word itself, all hashed into one table; a window of words is the mean of its words. Embeddings and softmax
are trained jointly, so a misspelling nobody has seen stands near the word whose n-grams it shares.

Labels are known for whole documents, while a few words make one toxic. So training goes over windows:
first every window carries its document's label, then each toxic document keeps the windows that score
highest. A document's score comes from its highest window, through a logistic curve fitted on documents.
As the softmax is linear, an n-gram adds one number to a window's score; scoring sums those.

A null or empty text, or one without words, scores 0. Repeated rows are scored one by
one. The model is fitted on a bounded sample: of each class the `per_class` documents with the smallest hash
of their id among those with a text that has words; of a text of more than `max_bytes` bytes, STRETCHES
stretches spread evenly over it, with at most so many bytes together. If either class has no example, every score is 0. A
document with several labels is toxic if any says so; null labels and ids are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gableboard.llm import text_bytes as tb

PER_CLASS, MAX_BYTES = 2000, 1 << 14
STRETCHES = 8
BUCKETS, DIMENSIONS, GRAMS = 1 << 17, 16, (3, 4, 5)
WINDOW, STRIDE = 8, 4


def _stream(data: np.ndarray, offsets: np.ndarray):
    """Folded bytes of the words with one 0 around each, the place of the 0 before each word and one more,
    the bucket of each word, and the number of words before each text. A word said again at once counts once."""
    starts, ends, first = tb.spans(data, offsets, tb.LETTERS_DIGITS)
    hashes = tb.word_hashes(data, starts, ends)
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[first[:-1][np.diff(first) > 0]] = True
    starts, ends = starts[keep], ends[keep]
    first = np.concatenate([[0], np.cumsum(keep)])[first]
    words = (hashes[keep] >> np.uint64(47)).astype(np.int64)
    lengths = ends - starts
    begin = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=begin[1:])
    out = np.zeros(begin[-1] + 1, np.uint8)
    inside = np.ones(begin[-1], bool)
    inside[begin[:-1]] = False
    place = np.repeat(starts - begin[:-1] - 1, lengths + 1)[inside] + np.flatnonzero(inside)
    out[np.flatnonzero(inside)] = tb.FOLD[data[place]]
    return out, begin, words, first


def _grams(stream: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n bytes from each place on, and whether they lie in one word and its borders."""
    size = max(0, len(stream) - n + 1)
    code, inside = np.full(size, n, np.uint64), np.ones(size, bool)
    for j in range(n):
        part = stream[j:j + size]
        code = code * np.uint64(257) + part + np.uint64(1)
        if 0 < j < n - 1:
            inside &= part != 0
    code *= np.uint64(0x9E3779B97F4A7C15)
    return (code >> np.uint64(47)).astype(np.int64), inside


def word_values(data, offsets, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean of `values` over the n-grams of each word; and the number of words before each text."""
    stream, begin, words, first = _stream(data, offsets)
    total = values[words].astype(np.float64)
    count = np.ones(len(total))
    for n in GRAMS:
        buckets, inside = _grams(stream, n)
        sums, times = np.zeros(len(buckets) + 1), np.zeros(len(buckets) + 1, np.int64)
        np.cumsum(np.where(inside, values[buckets], 0), out=sums[1:])
        np.cumsum(inside, out=times[1:])
        # From the border before a word to the last place whose n-gram ends at the border after it.
        a = np.minimum(begin[:-1], len(buckets))
        b = np.clip(begin[1:] + 1 - n + 1, a, len(buckets))
        total += sums[b] - sums[a]
        count += times[b] - times[a]
    return total / count, first


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and end of the windows of each text; a text without words has one empty window."""
    n = np.diff(first)
    times = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), times)
    nth = np.arange(len(text)) - (np.cumsum(times) - times)[text]
    begin = first[text] + np.maximum(0, np.minimum(nth * STRIDE, n[text] - WINDOW))
    return text, begin, np.minimum(begin + WINDOW, first[text + 1])


@dataclass
class Model:
    values: np.ndarray  # what an n-gram of a bucket adds to the difference of the two classes
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, column) -> np.ndarray:
        """The highest window's margin of each text; minus infinity without words."""
        data, offsets = tb.utf8(column)
        out = np.zeros(len(offsets) - 1)
        for i, j in tb.groups(offsets):
            value, first = word_values(data, offsets[i:j + 1], self.values)
            sums = np.zeros(len(value) + 1)
            np.cumsum(value, out=sums[1:])
            text, a, b = windows(first)
            margin = np.where(b > a, (sums[b] - sums[a]) / np.maximum(b - a, 1) + self.bias, -np.inf)
            out[i:j] = np.maximum.reduceat(margin, np.searchsorted(text, np.arange(j - i)))
        return out

    def scores(self, column) -> np.ndarray:
        margin = self.margins(column)
        at = self.slope * np.where(np.isfinite(margin), margin, 0) + self.shift
        return np.where(np.isfinite(margin), 1 / (1 + np.exp(-np.clip(at, -500, 500))), 0.0)


def _bags(texts: list[str]):
    """N-gram buckets of all windows, their weights, the bounds of each window, and its text."""
    ids, weights, sizes, owners = [], [], [], []
    for number, text in enumerate(texts):
        data, offsets = tb.utf8(pa.array([text]))
        stream, begin, words, _ = _stream(data, offsets)
        n = len(begin) - 1
        word, bucket = [np.arange(n)], [words]
        for k in GRAMS:
            buckets, inside = _grams(stream, k)
            at = np.flatnonzero(inside)
            word.append(np.searchsorted(begin, at, "right") - 1)
            bucket.append(buckets[at])
        word, bucket = np.concatenate(word), np.concatenate(bucket)
        order = np.argsort(word, kind="stable")
        word, bucket = word[order], bucket[order]
        share = 1 / np.bincount(word, minlength=n)
        bounds = np.searchsorted(word, np.arange(n + 1))
        for a in range(0, max(n, 1), WINDOW):
            b = min(a + WINDOW, n)
            if a < b:
                ids.append(bucket[bounds[a]:bounds[b]])
                weights.append(share[word[bounds[a]:bounds[b]]] / (b - a))
                sizes.append(len(ids[-1]))
                owners.append(number)
    return ids, weights, np.array(sizes), np.array(owners)


def train(texts: list[str], toxic: list[int], seed: int = 7, epochs: int = 4, batch: int = 1024, rate: float = 0.5) -> Model | None:
    """Joint training of embeddings and softmax by Adagrad on windows; None without both classes.

    Every third text, if there are enough, is kept for the logistic curve, so that it knows how windows that
    were not trained on score."""
    if len(set(toxic)) < 2:
        return None
    every_text, every_label = texts, np.array(toxic, np.int64)
    aside = np.arange(len(texts)) % 3 == 2
    if min(np.bincount(every_label[aside], minlength=2)) < 20:
        aside[:] = False
    texts, label = [t for t, a in zip(texts, aside, strict=True) if not a], every_label[~aside]
    ids, weights, sizes, owner = _bags(texts)
    chosen, target = np.arange(len(ids)), label[owner]

    def margins(part):
        values = table @ (softmax[:, 1] - softmax[:, 0])
        flat = np.concatenate([ids[i] for i in part])
        each = values[flat] * np.concatenate([weights[i] for i in part])
        return np.add.reduceat(each, np.cumsum(sizes[part]) - sizes[part]) + bias[1] - bias[0]

    for turn in range(2):
        if turn:
            # A toxic document's best windows, and all windows of the others.
            value = np.concatenate([margins(p) for p in np.array_split(np.arange(len(ids)), max(1, len(ids) // 4096))])
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, owner, value)
            chosen = np.flatnonzero((label[owner] == 0) | (value >= np.minimum(best, np.maximum(best / 2, 0))[owner]))
        # Each turn starts anew, so that nothing stays of what windows without a toxic word had taught.
        rng = np.random.default_rng(seed)
        table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
        softmax, bias = rng.normal(0, 0.1, (DIMENSIONS, 2)), np.zeros(2)
        seen_table, seen_softmax, seen_bias = np.full(BUCKETS, 1e-8), np.full((DIMENSIONS, 2), 1e-8), np.full(2, 1e-8)
        y = target[chosen]
        size = min(batch, max(32, len(chosen) // 50))
        balance = np.where(y == 1, len(y) / (2 * max(1, y.sum())), len(y) / (2 * max(1, (1 - y).sum())))
        for _ in range(epochs):
            order = rng.permutation(len(chosen))
            for at in range(0, len(order), size):
                part = chosen[order[at:at + size]]
                share = 1 / (1 + np.exp(-np.clip(margins(part), -30, 30)))
                error = (share - target[part]) * balance[order[at:at + size]] / len(part)
                flat = np.concatenate([ids[i] for i in part])
                weight = np.repeat(error, sizes[part]) * np.concatenate([weights[i] for i in part])
                pull = np.bincount(flat, weight, BUCKETS)  # the gradient of a row is pull times the softmax' difference
                rows = np.flatnonzero(pull)
                difference = softmax[:, 1] - softmax[:, 0]
                slope = pull[rows] @ table[rows]
                gradient = np.stack([-slope, slope], axis=1)
                step = pull[rows]
                seen_table[rows] += step ** 2 * (difference ** 2).mean()
                table[rows] -= rate * (step / np.sqrt(seen_table[rows]))[:, None] * difference / (np.abs(difference).mean() + 1e-8) * 0.1
                seen_softmax += gradient ** 2
                softmax -= 0.1 * rate * gradient / np.sqrt(seen_softmax)
                push = np.array([-error.sum(), error.sum()])
                seen_bias += push ** 2
                bias -= 0.1 * rate * push / np.sqrt(seen_bias)
    model = Model((table @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))
    judged = aside if aside.any() else ~aside
    texts = [t for t, j in zip(every_text, judged, strict=True) if j]
    return _calibrated(model, model.margins(pa.array(texts)), every_label[judged])


def _calibrated(model: Model, margin: np.ndarray, label: np.ndarray) -> Model:
    """The logistic curve of documents over their highest windows' margins, by Newton's method."""
    label, margin = label[np.isfinite(margin)], margin[np.isfinite(margin)]
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weight = np.array([1.0, 0.0])
    for _ in range(50):
        share = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (label - share) - np.array([1e-2, 0]) * (weight - np.array([1.0, 0]))
        curve = (x * (share * (1 - share))[:, None]).T @ x + np.diag([1e-2, 1e-6])
        step = np.linalg.solve(curve, slope)
        weight = weight + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    if weight[0] > 0:
        model.slope, model.shift = float(weight[0]), float(weight[1])
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model | None:
    known = labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("y")).dropna()
    known = known.groupBy("_id").agg(F.max("y").alias("y"))
    # A character has at most 4 bytes.
    chars = max(1, max_bytes // (4 * STRETCHES) - 1)
    start = lambda i: F.floor((F.length("t") - chars) * i / (STRETCHES - 1)).cast("int") + 1
    spread = F.concat_ws(" ", *(F.col("t").substr(start(i), F.lit(chars)) for i in range(STRETCHES)))
    texts = docs.select(F.col(key).alias("_id"), F.col(text).alias("t")).filter(F.col("t").rlike(r"[0-9A-Za-z[^\x00-\x7F]]"))
    known = known.join(texts.select("_id"), "_id", "left_semi")
    order = W.partitionBy("y").orderBy(F.xxhash64("_id"), "_id")
    ids = known.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_class).select("_id", "y")
    texts = texts.withColumn("t", F.when(F.octet_length("t") <= max_bytes, F.col("t")).otherwise(spread))
    # At most 2 * per_class ids.
    found = texts.join(F.broadcast(ids), "_id").dropDuplicates(["_id"]).orderBy(F.xxhash64("_id"), "_id").collect()
    return train([r["t"] for r in found], [r["y"] for r in found])


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list | None = None) -> DataFrame:
    """The columns `keep` of docs with score and predicted."""
    kept = docs.select(*(keep or []), F.col(text).alias("_text"))
    fields = [f for f in kept.schema.fields if f.name != "_text"]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            share = shared.value.scores(batch.column("_text")) if shared.value else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(share), pa.array((share >= 0.5).astype(np.int32))],
                [*(f.name for f in fields), "score", "predicted"])

    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return kept.mapInArrow(run, schema)
