"""Language identification by prediction by partial matching (PPM) over bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from kindred.llm.common import map_slices, store

ORDER = 3
# characters of a piece; pieces and bytes of labelled text a language learns from, and most languages: they bound the model
PIECE = 8192
MAX_PIECES = 1000
MAX_BYTES = 2 << 20
MAX_LANGUAGES = 256
# steps of the hash by which a language is thinned
FINE = 1 << 40
LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"
# bytes scored at once
WINDOW = 1 << 20


def grams(raw: bytes, order: int = ORDER, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Each byte of a stretch behind the ``order`` bytes before it, as one number; zeros precede the text."""
    stop = len(raw) if stop is None else min(stop, len(raw))
    known = np.frombuffer(bytes(max(0, order - start)) + raw[max(0, start - order) : stop], np.uint8).astype(np.uint32)
    out = np.zeros(len(known) - order, np.uint32)
    for i in range(order + 1):
        out = out << np.uint32(8) | known[i : len(known) - order + i]
    return out


@dataclass
class Level:
    """Contexts of one length: code lengths in bits of known symbols, and of the escape from each context, by language."""

    known: np.ndarray  # context and symbol, sorted
    bits: np.ndarray  # of each known, per language, with all escapes it takes
    contexts: np.ndarray  # sorted
    escape: np.ndarray  # per context and language; 0 where the language never saw the context


@dataclass
class Model:
    languages: list[str]
    levels: list[Level]  # from the longest contexts to none

    def code_lengths(self, keys: np.ndarray) -> np.ndarray:
        """Bits of each gram under each language."""
        out = np.zeros((len(keys), len(self.languages)), np.float32)
        open_at = np.arange(len(keys))
        for depth, level in enumerate(self.levels):
            k = len(self.levels) - 1 - depth
            cut = keys & np.uint32((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(level.known, cut), len(level.known) - 1)
            hit = level.known[at] == cut
            if depth == 0 and hit.all():
                return level.bits[at]
            out[open_at[hit]] += level.bits[at[hit]]
            open_at, keys = open_at[~hit], keys[~hit]
            if not len(keys):
                break
            context = cut[~hit] >> np.uint32(8)
            at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
            seen = level.contexts[at] == context
            out[open_at[seen]] += level.escape[at[seen]]
        return out


def build(languages: list[str], language: np.ndarray, gram: np.ndarray, count: np.ndarray, order: int = ORDER) -> Model:
    """The model from counts of grams of the greatest order per language (by number).

    A symbol seen ``c`` times in a context seen ``n`` times with ``t`` different symbols costs log2((n + t) / c) bits; an
    escape to the next shorter context costs log2((n + t) / t); a context never seen costs nothing to leave; without
    context and unseen, a byte costs 8 bits more.
    """
    width = len(languages)
    below: Level | None = None
    levels: list[Level] = []
    for k in range(order + 1):
        cut = gram & np.uint32((1 << 8 * (k + 1)) - 1)
        known = np.unique(cut) if k else np.arange(256, dtype=np.uint32)
        times = np.zeros((len(known), width), np.float64)
        np.add.at(times, (np.searchsorted(known, cut), language), count)
        context = known >> np.uint32(8)
        contexts, first = np.unique(context, return_index=True)
        total = np.add.reduceat(times, first, axis=0)
        kinds = np.add.reduceat(times > 0, first, axis=0, dtype=np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
            own = np.log2((total + kinds)[np.searchsorted(contexts, context)] / times)
        if below is None:
            rest = np.full(times.shape, 8.0)
        else:
            rest = below.bits[np.searchsorted(below.known, known & np.uint32((1 << 8 * k) - 1))]
        bits = np.where(times > 0, own, escape[np.searchsorted(contexts, context)] + rest)
        below = Level(known, bits, contexts, escape)
        levels.append(below)
    for level in levels:
        level.bits, level.escape = level.bits.astype(np.float32), level.escape.astype(np.float32)
    return Model(languages, levels[::-1])


def fit(docs: DataFrame, order: int = ORDER, max_pieces: int = MAX_PIECES, max_bytes: int = MAX_BYTES) -> Model | None:
    """A model of the labelled rows of (doc_id, text, lang); None if there are none.

    Documents are cut in pieces of ``PIECE`` characters, each learned like a text of its own.  A language learns from its
    first ``max_pieces`` different pieces in order of a hash, until they reach ``max_bytes`` of text together, so it
    learns from many documents however long they are, from one piece at least, and the model stays bounded.  Only counts
    leave the tasks.  More than ``MAX_LANGUAGES`` labels are an error.
    """
    if not 1 <= order <= 3:
        raise ValueError("a context and its symbol fill 4 bytes at most")
    spark = docs.sparkSession
    texts = docs.where("lang is not null and text is not null").select(
        F.col("lang").cast("string"), F.col("text").cast("string"), F.xxhash64("doc_id", "text").alias("h")
    )

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
        out = [(lang, text[at : at + PIECE], h, at) for lang, text, h in rows for at in range(0, max(len(text), 1), PIECE)]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["lang", "text", "h", "at"])

    cut = map_slices(texts, "text", "lang string, text string, h long, at long", pieces).select("lang", "text", F.xxhash64("h", "at").alias("h"))
    keys, _ = store(cut.select("lang", "h", F.octet_length("text").cast("long").alias("size")).distinct(), "labelled")
    counts = {r["lang"]: r["count"] for r in keys.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"the model is bounded to {MAX_LANGUAGES} languages")
    if not counts:
        return None
    # a large language is thinned by the hash before its rows meet: some twice as many as wanted are left
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(FINE, 2 * max_pieces * FINE // n + 1))))
    first = keys.where(F.pmod("h", F.lit(FINE)) < share[F.col("lang")])
    by = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(FINE)), "h")
    ranked = first.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= max_pieces)
    before = F.sum("size").over(by.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    picked = [tuple(r) for r in ranked.withColumn("before", before).where(F.col("before") < max_bytes).select("lang", "h").collect()]
    languages = sorted({lang for lang, _ in picked})
    if not languages:
        return None
    number = {lang: i for i, lang in enumerate(languages)}
    sample = F.broadcast(spark.createDataFrame(picked, "lang string, h long"))
    chosen = cut.join(sample, ["lang", "h"]).dropDuplicates(["lang", "h"])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [(number[lang], *np.unique(grams(t.lower().encode(), order), return_counts=True)) for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([np.full(len(g), n, np.int32) for n, g, _ in parts])),
                pa.array(np.concatenate([g for _, g, _ in parts]).astype(np.int64)),
                pa.array(np.concatenate([c for *_, c in parts]).astype(np.int64)),
            ],
            names=["language", "gram", "n"],
        )

    counted = map_slices(chosen, "text", "language int, gram long, n long", count).groupBy("language", "gram").agg(F.sum("n").alias("n"))
    got = counted.toPandas()
    return build(languages, got["language"].to_numpy(), got["gram"].to_numpy().astype(np.uint32), got["n"].to_numpy(), order)


def score_texts(texts: list[str | None], model: Model, order: int = ORDER) -> np.ndarray:
    """Bits of each text under each language; of texts of any length, grams of a window of bytes at once."""
    total = np.zeros((len(texts), len(model.languages)))
    held: list[tuple[int, np.ndarray]] = []

    def add() -> None:
        if held:
            first = np.cumsum([0, *(len(keys) for _, keys in held[:-1])])
            sums = np.add.reduceat(model.code_lengths(np.concatenate([keys for _, keys in held])), first, axis=0, dtype=np.float64)
            np.add.at(total, [i for i, _ in held], sums)
            held.clear()

    size = 0
    for i, text in enumerate(texts):
        raw = (text or "").lower().encode()
        for start in range(0, len(raw), WINDOW):
            held.append((i, grams(raw, order, start, start + WINDOW)))
            size += len(held[-1][1])
            if size >= WINDOW:
                add()
                size = 0
    add()
    return total


def identify(docs: DataFrame, model: Model | None, order: int = ORDER) -> DataFrame:
    """(doc_id, lang_pred, score, bits) for every row of (doc_id, text).

    The language with the shortest code for the whole text wins, of equal ones the first by name; ``score`` is its
    share if every language is as likely beforehand, ``bits`` its code length.  Null texts, texts without a letter, and
    all texts if nothing was learned, give ``und`` and score 0.  Equal texts give equal results; other columns are
    ignored; no rows in, no rows out.  Texts of any length are scored whole, a window of their bytes at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, texts = shared.value, batch.column("text").to_pylist()
        lettered = np.array([t is not None and own is not None and LETTER.search(t) is not None for t in texts], bool)
        names, scores, bits = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        at = np.flatnonzero(lettered)
        if len(at):
            lengths = score_texts([texts[i] for i in at], own, order)
            best = np.argmin(lengths, axis=1)
            bits[at] = lengths[np.arange(len(at)), best]
            scores[at] = 1 / np.exp2(np.maximum(bits[at, None] - lengths, -1000)).sum(axis=1)
            for i, b in zip(at, best, strict=True):
                names[i] = own.languages[b]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(scores), pa.array(bits)], names=["doc_id", "lang_pred", "score", "bits"])

    cut = docs.select("doc_id", docs["text"].cast("string"))
    kind = cut.schema["doc_id"].dataType.simpleString()
    return map_slices(cut, "text", f"doc_id {kind}, lang_pred string, score double, bits double", kernel, WINDOW)
