"""Quality classifier by nearest-neighbour voting (operator 5).

Texts become tf-idf vectors over hashed byte pairs and a few counts of word
repetition; document frequencies come from all documents.  A bounded sample of
labelled texts is folded into a latent-semantic space, its vectors are
broadcast, and every document takes the similarity-weighted vote of its
nearest labelled vectors, from exact cosine products computed block by block.

Defined cases: a null text counts as empty; an empty text has no vector and
scores the smoothed share of label 1; a row without doc_id is not held out and
never learnt from; labels without a quality are ignored, a doc_id labelled
twice is learnt with each label; documents repeated with the same doc_id are
learnt once each and scored alike; of neighbours equally near the vote takes
any, with equal weights; a text of any length is weighed whole; without any
label every score is 0.5; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrose.llm.common import prepare, texts

PAIR_TERMS = 4096
# terms of repetition and case: a share of words or lines that reaches a step
SHARE_STEPS = [("repeated", s) for s in (0.05, 0.1, 0.2, 0.4, 0.6)] + [("again", s) for s in (0.5, 0.7, 0.8, 0.9)] + \
    [("capital", s) for s in (0.2, 0.5, 0.8)] + [("lines", s) for s in (0.2, 0.5)]
SHARE_WEIGHT = 7.0
TERMS = PAIR_TERMS + len(SHARE_STEPS)
LATENT = 48
MAX_LABELLED = 4000        # labelled texts that are learnt from, at most
NEIGHBOURS = 25
BLOCK = 256                # documents in one product


@functools.cache
def _pair_term() -> np.ndarray:
    mixed = np.arange(1 << 16, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - 12)).astype(np.int64)


def term_weights(text: str) -> np.ndarray:
    """Damped relative frequency of each term in one text."""
    data = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    out = np.zeros(TERMS, np.float32)
    if len(data) < 2:
        return out
    out[:PAIR_TERMS] = np.bincount(_pair_term()[(data[:-1] << 8) | data[1:]], minlength=PAIR_TERMS)
    out[:PAIR_TERMS] *= 1000 / (len(data) - 1)
    out = np.log1p(out)
    words = text.split()
    if words:
        lines = [x for x in text.split("\n") if x]
        n = len(words)
        share = {"repeated": sum(map(str.__eq__, words, words[1:])) / n, "again": 1 - len(set(words)) / n,
                 "capital": sum(map(str.isupper, words)) / n, "lines": 1 - len(set(lines)) / max(1, len(lines))}
        out[PAIR_TERMS:] = [SHARE_WEIGHT if share[kind] >= step else 0 for kind, step in SHARE_STEPS]
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the doc_id's text leaves 1 when divided by 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def document_frequencies(base: DataFrame) -> tuple[int, np.ndarray]:
    """Number of non-empty documents and, of each term, the documents that hold it."""
    def count(batches):
        total, n = np.zeros(TERMS, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                if text:
                    total += term_weights(text) > 0
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["term", "n"])

    rows = (base.select("text").mapInArrow(count, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())   # at most TERMS + 1 rows
    out = np.zeros(TERMS, np.int64)
    n = 0
    for r in rows:
        if r["term"] < 0:
            n = r["n"]
        else:
            out[r["term"]] = r["n"]
    return n, out


@dataclasses.dataclass
class Model:
    """Everything a vote needs; its size depends on the parameters alone."""

    idf: np.ndarray
    axes: np.ndarray        # TERMS x LATENT
    vectors: np.ndarray     # labelled x LATENT, unit length
    labels: np.ndarray
    prior: float

    def embed(self, weights: np.ndarray) -> np.ndarray:
        latent = (weights * self.idf) @ self.axes
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, size, out=np.zeros_like(latent), where=size > 0)

    def score(self, weights: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Vote of the nearest labelled vectors, weighted by similarity, for a block."""
        if not len(self.labels):
            return np.full(len(weights), self.prior)
        near = self.embed(weights) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** 4
        votes = (w * self.labels[top]).sum(axis=1) + 0.01 * self.prior
        return np.where(weights.any(axis=1), votes / (w.sum(axis=1) + 0.01), self.prior)


def latent_axes(matrix: np.ndarray, rank: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by block power iteration from a fixed start."""
    rank = min(rank, *matrix.shape)
    block = matrix.T @ np.random.default_rng(7).standard_normal((matrix.shape[0], min(matrix.shape[0], rank + 16))).astype(np.float32)
    for _ in range(rounds):
        block = np.linalg.qr(block)[0]
        block = matrix.T @ (matrix @ block)
    basis = np.linalg.qr(block)[0]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :rank].astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Model:
    """Document frequencies over all documents; axes and vectors from a bounded
    sample of labelled documents that are not held out."""
    base = texts(docs, id_col, text_col)
    n, df = document_frequencies(base)
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id")).distinct())
    total = known.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, max_labelled / max(1, total)) * (1 << 20))
    # about max_labelled rows; beyond twice as many the hash decides, whatever the order of tasks
    chosen = known.filter(share).orderBy(F.xxhash64("doc_id", "label"), "doc_id").limit(2 * max_labelled)

    def weigh(batches):
        for b in batches:
            rows = [term_weights(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], ["label", "weights"])

    got = (base.join(F.broadcast(chosen), "doc_id").filter(F.length("text") > 0).select("label", "text")
           .orderBy(F.xxhash64("text", "label"), "text").limit(2 * max_labelled).mapInArrow(weigh, "label int, weights binary").collect())
    y = np.array([r["label"] for r in got], np.float64)
    prior = float((y.sum() + 1) / (len(y) + 2))
    if not len(y):
        return Model(idf, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y, 0.5)
    matrix = np.stack([np.frombuffer(r["weights"], np.float32) for r in got]) * idf
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    axes = latent_axes(matrix, LATENT)
    model = Model(idf, axes, np.zeros((0, axes.shape[1]), np.float32), y, prior)
    vectors = matrix @ axes
    model.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return model


def _scores(model: Model, values: list[str | None]) -> np.ndarray:
    out = [model.score(np.stack([term_weights(t or "") for t in values[i:i + BLOCK]]))
           for i in range(0, len(values), BLOCK)]
    return np.clip(np.concatenate(out), 0.0, 1.0) if out else np.zeros(0)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, max_labelled))
    base = texts(docs, id_col, text_col)
    kind = base.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(_scores(model.value, b.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return base.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, that score 0.5 or more."""
    spark = prepare(docs.sparkSession)
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, max_labelled))
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(model.value, b.column(at).to_pylist()) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
