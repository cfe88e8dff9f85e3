"""Quality classification: labelled neighbours in a latent-semantic space vote, weighted by cosine."""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kindred.llm.common import map_slices

# labelled documents that vote, at most: they bound the model and the work for each document
MAX_LABELLED = 4000
TERMS = 2048
# the last terms say how much of a text repeats the word before, and weigh as this many occurrences
REPEAT_LEVELS = 64
REPEAT_COUNT = 20
TOPICS = 64
NEIGHBOURS = 15
# votes count by this power of the cosine
SHARPNESS = 4
THRESHOLD = 0.3
BLOCK = 512


def _classes() -> np.ndarray:
    """Character classes of bytes: small letters and marks stand for themselves, capitals, digits and other letters for their kind."""
    out = np.zeros(256, np.uint32)
    out[128:] = 1
    for b in range(128):
        c = chr(b)
        out[b] = 2 if c.isupper() else 3 if c.isdigit() else b + 4
    return out


CLASSES = _classes()


def term_counts(texts: list[bytes | None]) -> np.ndarray:
    """How often each term occurs in each text.

    A term is a bucket of three neighbouring character classes, or a level that the share of words equal to the one
    before them reaches.
    """
    out = np.zeros((len(texts), TERMS), np.float32)
    buckets = TERMS - REPEAT_LEVELS
    for row, text in zip(out, texts, strict=True):
        raw = CLASSES[np.frombuffer(text or b"", np.uint8)]
        if len(raw) < 3:
            continue
        mixed = raw[:-2] * np.uint32(73856093)
        mixed ^= raw[1:-1] * np.uint32(19349663)
        mixed ^= raw[2:] * np.uint32(83492791)
        mixed *= np.uint32(2654435761)
        mixed >>= np.uint32(16)
        mixed *= np.uint32(buckets)
        mixed >>= np.uint32(16)
        row[:buckets] = np.bincount(mixed, minlength=buckets)
        words = text.lower().split()
        if len(words) > 1:
            again = sum(map(eq, words, words[1:])) / (len(words) - 1)
            row[buckets : buckets + int(np.ceil(REPEAT_LEVELS * again))] = REPEAT_COUNT
    return out


@dataclass
class Model:
    weights: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # terms x topics
    vectors: np.ndarray  # labelled x topics, of length 1
    labels: np.ndarray
    prior: float

    def embed(self, counts: np.ndarray) -> np.ndarray:
        """Latent-semantic vectors of length 1; zero for a text without terms."""
        weighted = np.log1p(counts) * self.weights
        norm = np.linalg.norm(weighted, axis=1, keepdims=True)
        latent = (weighted / np.maximum(norm, 1e-12)).astype(np.float32) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray, neighbours: int = NEIGHBOURS, sharpness: float = SHARPNESS) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors; all of them are compared, a block of texts at a time."""
        out = np.full(len(counts), self.prior)
        k, n = min(neighbours, len(self.labels)), len(self.labels)
        for at in range(0, len(counts), BLOCK):
            part = counts[at : at + BLOCK]
            # like cosines go to the earlier labelled row
            near = np.rint((self.embed(part) @ self.vectors.T) * 1e5).astype(np.int64) * n - np.arange(n)
            top = np.argpartition(near, n - k, axis=1)[:, n - k :] if k < n else np.tile(np.arange(n), (len(part), 1))
            cosine = (np.take_along_axis(near, top, axis=1) + top) // n / 1e5
            weight = np.maximum(cosine, 0) ** sharpness
            total = weight.sum(axis=1)
            share = (weight * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
            out[at : at + BLOCK] = np.where((part.sum(axis=1) > 0) & (total > 0), share, self.prior)
        return np.clip(out, 0.0, 1.0)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, and how many texts there are, over all rows."""

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = term_counts(batch.column("text").cast(pa.binary()).to_pylist())
        terms = np.flatnonzero(counts.any(axis=0))
        found = np.append((counts[:, terms] > 0).sum(axis=0), len(counts))
        return pa.RecordBatch.from_arrays([pa.array(np.append(terms, TERMS).astype(np.int32)), pa.array(found.astype(np.int64))], names=["term", "n"])

    sums = map_slices(docs.select(docs["text"].cast("string")), "text", "term int, n long", kernel).groupBy("term").agg(F.sum("n"))
    found = dict(sums.collect())
    return np.array([found.get(t, 0) for t in range(TERMS)], np.float64), found.get(TERMS, 0)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, topics: int = TOPICS) -> Model | None:
    """A model of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1); None without labelled documents.

    Term weights come from all documents, topics and votes from at most ``max_labelled`` labelled ones, the first in order
    of a hash of the id.  Labels of other values, null ids and repeated labels are left out; an id with both
    labels votes twice.
    """
    named = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int").alias("label")).distinct()
    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string"))
    # ids of rows that exist and have a label: chosen without their texts
    chosen = named.join(rows.select("label_id").distinct(), "label_id").orderBy(F.xxhash64("label_id"), "label_id", "label").limit(max_labelled)
    picked = [tuple(r) for r in chosen.collect()]
    if not picked:
        return None
    sample = F.broadcast(docs.sparkSession.createDataFrame(picked, "label_id long, label int"))
    texts = rows.join(sample, "label_id").dropDuplicates(["label_id", "label"])

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = term_counts(batch.column("text").cast(pa.binary()).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("label_id"), batch.column("label"), pa.array([c.tobytes() for c in counts], pa.binary())], names=["label_id", "label", "counts"])

    got = map_slices(texts.select("label_id", "label", "text"), "text", "label_id long, label int, counts binary", kernel).collect()
    got.sort(key=lambda r: (r.label_id, r.label))
    counts = np.stack([np.frombuffer(r.counts, np.float32) for r in got])
    label = np.array([r.label for r in got], np.float64)
    frequency, total = document_frequencies(docs)
    weights = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    weighted = np.log1p(counts) * weights
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
    _, vectors = np.linalg.eigh(weighted.T @ weighted)
    axes = np.ascontiguousarray(vectors[:, ::-1][:, : min(topics, TERMS)]).astype(np.float32)
    model = Model(weights, axes, np.zeros((0, axes.shape[1]), np.float32), label, float(label.mean()))
    model.vectors = model.embed(counts)
    return model


def _scores(batch: pa.RecordBatch, model: Model | None, neighbours: int) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    if model is None:
        return np.full(len(texts), 0.5)
    parts = [model.score(term_counts(texts[i : i + BLOCK]), neighbours) for i in range(0, len(texts), BLOCK)]
    return np.concatenate(parts) if parts else np.zeros(0)


def classify(docs: DataFrame, model: Model | None, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) for every row of (doc_id, text).

    ``score`` (0 to 1) is the weighted share of label 1 among the nearest labelled documents.  Null, empty and very
    short texts, which have no terms, get the share of label 1 among all labelled ones; without a model every score
    is 0.5.  Equal texts get equal scores; other columns are ignored; no rows in, no rows out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        score = _scores(batch, shared.value, neighbours)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    cut = docs.select("doc_id", docs["text"].cast("string"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return map_slices(cut, "text", f"doc_id {kind}, score double, predicted int", kernel)


def keep_good(docs: DataFrame, model: Model | None, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows predicted 1, with all their columns; a map over the partitions, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(_scores(batch, shared.value, neighbours) >= threshold))

    return map_slices(docs, "text", docs.schema, kernel)
