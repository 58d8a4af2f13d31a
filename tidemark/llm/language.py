"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters, lower case, every run of other characters than letters as one
space, are hashed to ``BUCKETS`` features, weighted (1 + log tf) * idf and scaled to length one.
Document frequencies come from every learning row. The weights are fitted with
follow-the-regularised-leader and an elastic net on a bounded sample: about ``PER_LANGUAGE`` rows of
each language; each of ``SHARDS`` tasks goes over its share ``EPOCHS`` times and the weights are
averaged. A fifth of the sample is held back to fit the temperature of the probabilities.

A text that is null or has no letter is ``und`` with score 0. With no learning rows everything is
``und``. Rows with null or repeated ids are predicted like others. Whole texts count, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, text_bytes
from tidemark.llm.pretokens import LETTER, class_table

BUCKETS_LOG2 = 14
BUCKETS = 1 << BUCKETS_LOG2
ORDERS = (1, 2, 3)
PER_LANGUAGE, SHARDS, EPOCHS = 3000, 4, 2
#: Step size, its smoothing, and the two penalties of the elastic net.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.02
UNKNOWN = "und"
#: Letters whose n-grams are counted at once, in 16 texts at most.
LETTERS = 1 << 17


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (buckets, languages)
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0


def counts_of(texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts (rows, BUCKETS)) of n-grams, for a few texts at a time."""
    table = class_table()
    ends = np.concatenate([[0], np.cumsum([max(len(t), LETTERS // 16) for t in texts])])
    for first, last in chunks(ends, LETTERS):
        some = texts[first:last]
        counts = np.zeros(len(some) * BUCKETS, np.int64)
        rows, points = [], []
        for row, text in enumerate(some):
            raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
            letter = table[np.minimum(raw, 0x10FFFF)] == LETTER
            keep = letter.copy()
            keep[0] = True
            keep[1:] |= letter[:-1]
            points.append(np.where(letter, raw, 32)[keep].astype(np.uint32))
            rows.append(len(points[-1]))
        flat = np.concatenate(points)
        row_of = np.repeat(np.arange(len(some)), rows)
        code = np.zeros(len(flat), np.uint32)
        for order in range(1, max(ORDERS) + 1):
            size = len(flat) - order + 1
            if size <= 0:
                break
            code = (code[:size] + flat[order - 1 :]) * np.uint32(0x9E3779B1)
            if order not in ORDERS:
                continue
            bucket = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(
                32 - BUCKETS_LOG2
            )
            same = row_of[:size] == row_of[order - 1 :]
            if order == 1:
                same &= flat != 32
            counts += np.bincount(
                row_of[:size][same] * BUCKETS + bucket[same], minlength=len(counts)
            )
        yield first, counts.reshape(len(some), BUCKETS)


def features(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, values) of one row, of length one."""
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt(value @ value)
    return at, value / norm if norm else value


def document_frequencies(learning: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows each feature occurs, over all rows, and how many rows there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets, 2 << 20):
                for _, counts in counts_of(batch.column("text")[a:b].to_pylist()):
                    seen[:-1] += (counts > 0).sum(axis=0)
                    seen[-1] += len(counts)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())], ["feature", "n"]
        )

    found = learning.select("text").mapInArrow(count, "feature int, n long")
    made = np.zeros(BUCKETS + 1, np.int64)
    for row in found.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        made[row["feature"]] = row["n"]
    return made[:-1], int(made[-1])


class Ftrl:
    """FTRL-proximal for a multinomial logistic model with few classes."""

    def __init__(self, classes: int) -> None:
        self.z = np.zeros((BUCKETS + 1, classes))
        self.n = np.zeros((BUCKETS + 1, classes))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.append(at, BUCKETS), np.append(value, 1.0)
        w = self.weights(at)
        p = softmax(value @ w)
        p[label] -= 1
        g = value[:, None] * p
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[at] = more


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(learning: DataFrame) -> Model | None:
    """A model from the rows (id, text, lang) that have text and lang; None if there are none. The
    id only draws the sample.

    The driver holds the document frequencies, the weights and the logits of the rows held back.
    """
    learning = learning.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in learning.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    frequency, rows = document_frequencies(learning)
    idf = np.log((1 + rows) / (1 + frequency)) + 1
    scale = 1 << 30
    share = F.create_map(
        *(F.lit(x) for k in languages for x in (k, int(scale * min(1, PER_LANGUAGE / sizes[k]))))
    )
    draw = F.xxhash64("id", "text", F.lit(17))
    sample = learning.where(F.pmod(draw, F.lit(scale)) < share[F.col("lang")])
    sample = sample.select(
        F.pmod(F.xxhash64("id", "text", F.lit(18)), F.lit(5)).alias("part"),
        F.pmod(F.xxhash64("id", "text", F.lit(19)), F.lit(SHARDS)).alias("shard"),
        "text",
        "lang",
    )
    number = {k: i for i, k in enumerate(languages)}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            labels += [number[k] for k in batch.column("lang").to_pylist()]
            for _, counts in counts_of(batch.column("text").to_pylist()):
                rows += [features(c, idf) for c in counts]
        own = Ftrl(len(languages))
        for _ in range(EPOCHS):
            for (at, value), label in zip(rows, labels, strict=True):
                own.learn(at, value, label)
        w = own.weights(np.arange(BUCKETS + 1)).astype("<f8")
        yield pa.RecordBatch.from_arrays(
            [pa.array([len(rows)], pa.int64()), pa.array([w.tobytes()], pa.binary())], ["n", "w"]
        )

    own = sample.where("part > 0").repartition(SHARDS, "shard").sortWithinPartitions("shard", "text")
    fitted = own.mapInArrow(train, "n long, w binary").where("n > 0").collect()
    total = sum(r["n"] for r in fitted)
    weights = np.zeros((BUCKETS + 1, len(languages)))
    for r in fitted:
        weights += np.frombuffer(r["w"], "<f8").reshape(weights.shape) * (r["n"] / total)
    model = Model(languages, weights[:-1], weights[-1], idf)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                features(c, idf) for _, counts in counts_of(batch.column("text").to_pylist()) for c in counts
            ]
            flat = [(v @ model.weights[at] + model.bias).tolist() for at, v in scores]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number[k] for k in batch.column("lang").to_pylist()], pa.int32()),
                    pa.array(flat, pa.list_(pa.float64())),
                ],
                ["label", "logits"],
            )

    held = sample.where("part = 0").select("text", "lang")
    held = held.mapInArrow(logits, "label int, logits array<double>").collect()
    if held:
        model.temperature = fit_temperature(
            np.array([r["logits"] for r in held]), np.array([r["label"] for r in held])
        )
    return model


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross-entropy, from a grid of factors."""
    grid = np.geomspace(0.5, 5, 60)
    each = np.arange(len(labels))
    loss = [-np.log(softmax(logits / t)[each, labels] + 1e-12).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): every row of ``docs`` as a struct, its language and how sure."""
    rows = docs.select(F.struct("*").alias("row"))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("row").field(text_col).cast(pa.string())
            _, offsets = text_bytes(texts.fill_null(""))
            for a, b in chunks(offsets, 2 << 20):
                part = batch.slice(a, b - a)
                lang, score = [], []
                some = [t or "" for t in texts[a:b].to_pylist()]
                for _, counts in counts_of(some):
                    for row in counts:
                        at, value = features(row, model.idf)
                        p = softmax((value @ model.weights[at] + model.bias) / model.temperature)
                        best = int(np.argmax(p))
                        seen = len(at) > 0
                        lang.append(model.languages[best] if seen else UNKNOWN)
                        score.append(float(p[best]) if seen else 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                    ["row", "lang_pred", "score"],
                )

    kept = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(work, f"row {kept}, lang_pred string, score double")


def is_held_out(id_column: Column) -> Column:
    """Rows kept out of learning: a third of all, by the CRC of their id as text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learning_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(id, text, lang) of the rows that may be learnt from."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    return rows.where(~is_held_out(F.col("id")))
