"""Text quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` bytes.  A passage is encoded as shares of byte-class pairs and its
shares of distinct 4- and 8-byte strings, passed through a learned layer; gated attention weights the passages, learned
from document labels alone, and the weighted passage representation is scored.

Training takes a bounded sample: per class ``TRAIN_DOCS`` labelled texts of at most ``TRAIN_PASSAGES`` passages,
chosen by a hash of the id; its texts come to the driver (at most 2 * TRAIN_DOCS * TRAIN_PASSAGES *
PASSAGE bytes).  Scoring covers every whole text; passages are encoded in slices, so a very long text needs no
more memory than its embeddings.

Defined cases: a null or empty text is one empty passage and gets a score like any other; repeated rows get
equal scores; a null id is scored and not held out; labels with null values or ids do not train, of contradictory
ones the lower counts; without labels of both classes every score is 0.5; further columns are not read;
an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.bpe import blocks
from contactloom.llm.common import map_arrow, texts

PASSAGE = 512
TRAIN_DOCS = 1200
TRAIN_PASSAGES = 48
HIDDEN, GATE = 24, 12
EPOCHS, RATE, DECAY = 150, 0.02, 1e-4
ACCEPT = 0.3
SLICE = 4096
BLOCK_CHARS = 2_000_000

# Byte classes: 0 padding, then one class for each of these groups, the rest of ASCII, lead and continuation bytes.
GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", ".,;:", "!?", "#*$%&", "|<>", "\"'()[]{}", "-_/=+@"]
CLASSES = len(GROUPS) + 4
PAIRS = CLASSES * CLASSES
FEATURES = PAIRS + 3


def _byte_classes() -> np.ndarray:
    table = np.full(256, len(GROUPS) + 1, np.uint8)
    for i, group in enumerate(GROUPS):
        table[np.frombuffer(group.encode(), np.uint8)] = i + 1
    table[128:192], table[192:], table[0] = len(GROUPS) + 3, len(GROUPS) + 2, 0
    return table


BYTE_CLASS = _byte_classes()


def _distinct_share(grams: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Distinct strings among the first size - width + 1 of each row."""
    count = np.maximum(sizes - width + 1, 1)
    grams = np.where(np.arange(grams.shape[1])[None, :] < count[:, None], grams, grams.dtype.type(0))
    grams.sort(axis=1)
    distinct = (grams[:, 1:] != grams[:, :-1]).sum(axis=1) + (count >= grams.shape[1])
    return np.minimum(distinct / count, 1.0)


def encode_passages(matrix: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of passages, given as rows of bytes padded with 0."""
    classes = BYTE_CLASS[matrix].astype(np.int32)
    pairs = classes[:, :-1] * CLASSES + classes[:, 1:]
    rows = np.arange(len(matrix), dtype=np.int32)[:, None] * PAIRS
    counts = np.bincount((pairs + rows).ravel(), minlength=len(matrix) * PAIRS).reshape(-1, PAIRS).astype(np.float32)
    counts[:, 0] = 0  # padding
    out = np.empty((len(matrix), FEATURES), np.float32)
    out[:, :PAIRS] = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    wide = matrix.astype(np.uint32)
    four = (wide[:, :-3] << 24) | (wide[:, 1:-2] << 16) | (wide[:, 2:-1] << 8) | wide[:, 3:]
    eight = four[:, :-4] * np.uint32(2654435761) ^ four[:, 4:]
    out[:, PAIRS] = _distinct_share(four, sizes, 4)
    out[:, PAIRS + 1] = _distinct_share(eight, sizes, 8)
    out[:, PAIRS + 2] = sizes / PASSAGE
    return out


def passages(block: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows of bytes, their sizes, passages per text); an empty text has one empty passage."""
    raw = [t.encode("utf-8", "replace") for t in block]
    sizes = np.array([len(r) for r in raw])
    number = np.maximum(-(-sizes // PASSAGE), 1)
    matrix = np.zeros((int(number.sum()), PASSAGE), np.uint8)
    flat, at = matrix.reshape(-1), (np.cumsum(number) - number) * PASSAGE
    for r, a in zip(raw, at.tolist()):
        flat[a : a + len(r)] = np.frombuffer(r, np.uint8)
    last = np.cumsum(number) - 1
    own = np.full(len(matrix), PASSAGE)
    own[last] = sizes - (number - 1) * PASSAGE
    return matrix, own, number


@dataclass
class Model:
    """Weights; ``parts`` holds them by name.  None: there was nothing to learn from."""

    parts: dict[str, np.ndarray] | None

    def embed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Passage representations and attention logits."""
        p = self.parts
        h = np.tanh(((x - p["mean"]) / p["std"]) @ p["w"] + p["b"])
        e = (np.tanh(h @ p["v"]) / (1 + np.exp(-(h @ p["u"])))) @ p["a"]
        return h, e

    def score(self, block: list[str]) -> np.ndarray:
        if not block:
            return np.zeros(0)
        if self.parts is None:
            return np.full(len(block), 0.5)
        matrix, sizes, number = passages(block)
        cut = [self.embed(encode_passages(matrix[i : i + SLICE], sizes[i : i + SLICE])) for i in range(0, len(matrix), SLICE)]
        h, e = np.concatenate([c[0] for c in cut]), np.concatenate([c[1] for c in cut])
        starts = np.cumsum(number) - number
        weight = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), number))
        weight /= np.repeat(np.add.reduceat(weight, starts), number)
        z = np.add.reduceat(h * weight[:, None], starts) @ self.parts["c"] + self.parts["d"]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(block: list[str], labels: list[int], seed: int = 7) -> Model:
    """Adam on all bags at once; the labels are those of documents, never of passages."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return Model(None)
    matrix, sizes, number = passages(block)
    x = np.concatenate([encode_passages(matrix[i : i + SLICE], sizes[i : i + SLICE]) for i in range(0, len(matrix), SLICE)]).astype(np.float64)
    mean, std = x.mean(0), x.std(0) + 0.02
    x = (x - mean) / std
    starts, bag = np.cumsum(number) - number, np.repeat(np.arange(len(number)), number)
    rng = np.random.default_rng(seed)
    p = {
        "w": rng.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
        "v": rng.normal(0, 0.3, (HIDDEN, GATE)), "u": rng.normal(0, 0.3, (HIDDEN, GATE)), "a": rng.normal(0, 0.3, GATE),
        "c": rng.normal(0, 0.3, HIDDEN), "d": np.zeros(1),
    }
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for step in range(1, EPOCHS + 1):
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["a"]
        weight = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        weight /= np.add.reduceat(weight, starts)[bag]
        z = np.add.reduceat(h * weight[:, None], starts)
        prob = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        dz = balance * (prob - y) / len(y)
        dbag = dz[:, None] * p["c"]
        inner = (h * dbag[bag]).sum(1)
        de = weight * (inner - np.add.reduceat(weight * inner, starts)[bag])
        dgate = de[:, None] * p["a"]
        dt, ds = dgate * s * (1 - t * t), dgate * t * s * (1 - s)
        dh = (weight[:, None] * dbag[bag] + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        grad = {
            "w": x.T @ dh, "b": dh.sum(0), "v": h.T @ dt, "u": h.T @ ds, "a": (t * s).T @ de, "c": z.T @ dz, "d": dz.sum(keepdims=True),
        }
        for k in p:
            g = grad[k] + DECAY * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * g
            m2[k] = 0.999 * m2[k] + 0.001 * g * g
            p[k] = p[k] - RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
    return Model({k: v.astype(np.float32) for k, v in (p | {"mean": mean, "std": std}).items()})


def held_out(doc_id: Column) -> Column:
    """The fifth of ids whose labels no model sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labels (doc_id, quality) of ids that are not held out."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .withColumn("_rank", F.xxhash64("doc_id"))
    )
    part = [known.where(F.col("quality") == q).orderBy("_rank", "doc_id").limit(TRAIN_DOCS) for q in (0, 1)]
    chosen = F.broadcast(part[0].unionByName(part[1]))  # at most 2 * TRAIN_DOCS rows
    rows = (
        texts(docs).join(chosen, "doc_id").where(F.octet_length("text") <= TRAIN_PASSAGES * PASSAGE)
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"), F.min("_rank").alias("_rank"))
        .collect()
    )
    rows.sort(key=lambda r: (r["_rank"], r["doc_id"]))
    return fit([r["text"] for r in rows], [r["quality"] for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(1), BLOCK_CHARS):
                scores = model.score(block).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(block)), pa.array(scores)], names=["doc_id", "score"]
                )

    return map_arrow(texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text"), run, "doc_id bigint, score double")


def accepted(docs: DataFrame, model: Model, at: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that score at least ``at``, with all their columns, in one pass without a shuffle."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(place), BLOCK_CHARS):
                yield batch.slice(start, len(block)).filter(pa.array(model.score(block) >= at))

    return map_arrow(docs, run, docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return score(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted")
    )
