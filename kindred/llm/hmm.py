"""A hidden Markov language model over word classes, trained by Baum-Welch over all partitions.

A token's probability is that of its class in the hidden state, times that of the word in its class.  The most
frequent words are classes of their own, as many as the corpus has; other words share a class with those that end
alike.  Word counts grow with the corpus and stay tables; the hidden states see classes.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from kindred.llm.common import map_slices, slices, store

STATES = 8
# words seen so often are classes of their own, the most frequent ones up to a number that bounds the sums; others share classes
OWN_COUNT = 30
OWN_CLASSES = 16_000
ENDING_CLASSES = 512
# frequent words known in every task, at most; counts of all others are joined
HEAD = 200_000
ITERATIONS = 5
# tokens of a stretch in training: long texts are cut there, each stretch starts anew
STRETCH = 256
# different stretches, drawn by a hash of their content from all stretches of all texts, among which the first centres are
# chosen; rounds in which the centres are then fitted to all stretches
SEEDS = 256
MIXTURE_ROUNDS = 2
# distinct words a task counts before it sends them on
FLUSH = 500_000
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    """Words of the text with A to Z in lower case, and one end."""
    return [*(text or b"").lower().split(), END]


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDING_CLASSES


def word_counts(docs: DataFrame) -> DataFrame:
    """(token, c): how often each token occurs in all texts; added up in tasks before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["token", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    seen.update(tokens(text))
                if len(seen) > FLUSH:
                    yield rows()
        yield rows()

    counted = docs.select(docs["text"].cast("string")).mapInArrow(run, "token binary, c long")
    return counted.groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Lexicon:
    """What every task knows of the words; bounded by HEAD words and the classes."""

    total: int  # N
    distinct: int  # V
    head: list[bytes]  # frequent words, the most frequent first, then the end if it was seen
    counts: np.ndarray  # of the head
    classes: np.ndarray  # of the head
    class_tokens: np.ndarray  # tokens of each ending class
    class_rest: np.ndarray  # what each keeps for words never seen, as tokens: its words seen once, and one
    own: int

    @property
    def n_classes(self) -> int:
        return self.own + 1 + ENDING_CLASSES

    def base_log(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.distinct + 1))

    def word_log(self, c: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 of the probability of a word in its class; a class of one word, or the end, is sure."""
        shared = classes > self.own
        ending = np.where(shared, classes - self.own - 1, 0)
        all_tokens = self.class_tokens[ending] + self.class_rest[ending]
        return np.where(shared, np.log10(np.where(c > 0, c, self.class_rest[ending]) / all_tokens), 0.0)


def lexicon(counts: DataFrame, head: int = HEAD, own_count: int = OWN_COUNT, own: int = OWN_CLASSES) -> Lexicon:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = counts.where(F.octet_length("token") > 0)
    # levels of frequency, some twenty to a doubling, of which as many of the highest as fit are taken whole
    level = F.floor(F.log2("c") * 20).cast("int")
    fits = head
    least = None
    for found, n in sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True):
        fits -= n
        if fits < 0:
            break
        least = found
    top = words.where(level >= least).collect() if least is not None else []
    top.sort(key=lambda r: (-r.c, bytes(r.token)))
    names, c = [bytes(r.token) for r in top], np.array([r.c for r in top], np.int64)
    own = min(own, int(np.count_nonzero(c >= own_count)))
    ending = F.pmod(F.crc32(F.expr("substring(token, -3, 3)")), F.lit(ENDING_CLASSES)).cast("int").alias("e")
    sums = words.groupBy(ending).agg(F.sum("c").alias("n"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()
    class_tokens, rest = np.zeros(ENDING_CLASSES), np.ones(ENDING_CLASSES)
    for e, n, once in sums:
        class_tokens[e], rest[e] = n, once + 1
    classes = np.array([own + 1 + ending_class(w) for w in names], np.int64)
    for i in range(own):
        e = classes[i] - own - 1
        class_tokens[e] -= c[i]
        rest[e] -= c[i] == 1
    classes[:own] = np.arange(own)
    ends = counts.where(F.octet_length("token") == 0).collect()
    if ends:
        names, c, classes = [*names, END], np.append(c, ends[0].c), np.append(classes, own)
    return Lexicon(total, distinct, names, c, classes, class_tokens, rest, own)


ENCODED = (
    "uid long, doc_id {kind}, learn boolean, n_tokens long, n_known long, base double, words double, classes binary, "
    "tail array<struct<token: binary, n: int, e: int>>"
)


def encode(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Rows of (doc_id, text, learn) as classes, with the sums over frequent words and the list of all others."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    kind = docs.schema["doc_id"].dataType.simpleString()
    tail_type = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int32()), ("e", pa.int32())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        place = {w: i for i, w in enumerate(own.head)}
        base, inside = own.base_log(own.counts), own.word_log(own.counts, own.classes)
        uid = TaskContext.get().partitionId() << 33

        def sums(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
            return np.bincount(row, weights=values, minlength=n).astype(np.float64)

        for batch in batches:
            for part in slices(batch, "text"):
                split = [tokens(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
                n = np.fromiter(map(len, split), np.int64, len(split))
                flat = [w for words in split for w in words]
                at = np.fromiter(map(place.get, flat, repeat(-1)), np.int64, len(flat))
                row, known = np.repeat(np.arange(len(n)), n), at >= 0
                classes = np.zeros(len(flat), np.uint16)
                classes[known] = own.classes[at[known]]
                tails: list[Counter] = [Counter() for _ in split]
                for i in np.flatnonzero(~known).tolist():
                    word = flat[i]
                    if word:
                        classes[i] = own.own + 1 + ending_class(word)
                    else:
                        classes[i] = own.own
                    tails[row[i]][word] += 1
                raw, starts = classes.astype("<u2").tobytes(), np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uid + np.arange(len(n))), part.column("doc_id"), part.column("learn"), pa.array(n),
                        pa.array(sums(known * 1.0, row, len(n)).astype(np.int64)),
                        pa.array(sums(base[at[known]], row[known], len(n))),
                        pa.array(sums(inside[at[known]], row[known], len(n))),
                        pa.array([raw[2 * s : 2 * (s + m)] for s, m in zip(starts.tolist(), n.tolist(), strict=True)], pa.binary()),
                        pa.array([[{"token": w, "n": m, "e": ending_class(w) if w else -1} for w, m in t.items()] for t in tails], tail_type),
                    ],
                    names=["uid", "doc_id", "learn", "n_tokens", "n_known", "base", "words", "classes", "tail"],
                )
                uid += len(n)

    return docs.select("doc_id", docs["text"].cast("string"), "learn").mapInArrow(run, ENCODED.format(kind=kind))


class Packed:
    """Sequences side by side, longest first: the values of one step of all that reach it stand together."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        self.order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max()) if len(lengths) else 0
        ending = np.bincount(lengths, minlength=longest + 1)
        self.active = (len(lengths) - np.cumsum(ending)[:longest]).tolist()
        offset = np.concatenate([[0], np.cumsum(self.active, dtype=np.int64)])
        sorted_lengths = lengths[self.order]
        step = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(sorted_lengths) - sorted_lengths, sorted_lengths)
        self.flat = np.empty(len(step), np.int32)
        if len(step):
            self.flat[offset[step] + np.repeat(np.arange(len(lengths)), sorted_lengths)] = np.concatenate([sequences[i] for i in self.order])
        self.offset = offset.tolist()


@dataclass
class Chain:
    start: np.ndarray
    move: np.ndarray  # from state, to state
    emit: np.ndarray  # class, state

    def forward(self, sequences: list[np.ndarray]) -> np.ndarray:
        """log10 of the probability of each class sequence: the scaled forward recursion, all sequences in step."""
        packed = Packed(sequences)
        out = np.zeros(len(sequences))
        state = None
        for t, active in enumerate(packed.active):
            seen = self.emit[packed.flat[packed.offset[t] : packed.offset[t] + active]]
            state = seen * self.start if state is None else (state[:active] @ self.move) * seen
            scale = state.sum(axis=1)
            state /= scale[:, None]
            out[packed.order[:active]] += np.log10(scale)
        return out

    def expected(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts of starts, moves and emissions, and the log10 likelihood: forward and backward."""
        packed = Packed(sequences)
        k = len(self.start)
        ahead = np.empty((len(packed.flat), k), np.float32)
        scales = np.empty(len(packed.flat), np.float32)
        emit, move, state = self.emit.astype(np.float32), self.move.astype(np.float32), None
        for t, active in enumerate(packed.active):
            span = slice(packed.offset[t], packed.offset[t] + active)
            seen = emit[packed.flat[span]]
            state = seen * self.start.astype(np.float32) if state is None else (state[:active] @ move) * seen
            scale = state.sum(axis=1)
            state /= scale[:, None]
            ahead[span], scales[span] = state, scale
        moves = np.zeros((k, k))
        behind = np.ones((packed.active[0] if len(packed.active) else 0, k), np.float32)
        for t in range(len(packed.active) - 1, -1, -1):
            if t + 1 < len(packed.active):
                active = packed.active[t + 1]
                following = slice(packed.offset[t + 1], packed.offset[t + 1] + active)
                later = emit[packed.flat[following]] * behind[:active]
                later /= scales[following, None]
                moves += ahead[packed.offset[t] : packed.offset[t] + active].T @ later
                # what stood there is used up: from here on it holds the chance of each state given the whole sequence
                ahead[following] *= behind[:active]
                behind[:active] = later @ move.T
        first = packed.active[0] if len(packed.active) else 0
        ahead[:first] *= behind
        gamma = ahead
        emits = np.stack([np.bincount(packed.flat, weights=gamma[:, s], minlength=len(self.emit)) for s in range(k)], axis=1)
        starts = gamma[:first].sum(axis=0, dtype=np.float64)
        return starts, moves * self.move, emits, float(np.log10(scales, dtype=np.float64).sum())


def _sequences(batch: pa.RecordBatch, stretch: int | None = None) -> list[np.ndarray]:
    whole = [np.frombuffer(c, "<u2") for c in batch.column("classes").to_pylist()]
    return whole if stretch is None else [s[i : i + stretch] for s in whole for i in range(0, len(s), stretch)]


def first_stretches(data: DataFrame, n: int = SEEDS) -> list[np.ndarray]:
    """``n`` different stretches of all sequences, those with the smallest hashes of their content, in that order.

    They do not depend on how rows are dealt to partitions or ordered, and may stand anywhere in a text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, bytes] = {}
        for batch in batches:
            for part in slices(batch, "classes", 2 << 20, 1 << 30):
                for stretch in _sequences(part, STRETCH):
                    raw = stretch.tobytes()
                    least[xxhash.xxh64_intdigest(raw) >> 1] = raw
                if len(least) > 4 * n:
                    least = dict(sorted(least.items())[:n])
        least = dict(sorted(least.items())[:n])
        yield pa.RecordBatch.from_arrays([pa.array(least.keys(), pa.int64()), pa.array(least.values(), pa.binary())], names=["h", "part"])

    drawn = data.mapInArrow(run, "h long, part binary").groupBy("h").agg(F.min("part").alias("part"))
    return [np.frombuffer(r.part, "<u2") for r in drawn.orderBy("h").limit(n).collect()]


def first_centres(sample: list[np.ndarray], n_classes: int, states: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Prior and class frequencies (class, state) of a mixture fitted to a few stretches."""
    rng = np.random.default_rng(seed)
    counts = np.stack([np.bincount(s, minlength=n_classes) for s in sample]) if sample else np.ones((1, n_classes))
    overall = counts.sum(axis=0) + 0.1
    overall = overall / overall.sum()
    # centres far from one another in the direction of their (rooted) frequencies
    direction = np.sqrt(counts) / np.maximum(np.sqrt(counts.sum(axis=1, keepdims=True)), 1)
    centres = [int(rng.integers(len(direction)))]
    while len(centres) < states:
        far = np.maximum(1 - (direction @ direction[centres].T).max(axis=1), 0) ** 2
        centres.append(int(rng.choice(len(far), p=far / far.sum())) if far.sum() > 0 else int(rng.integers(len(far))))
    share = direction @ direction[centres].T
    weight = (share == share.max(axis=1, keepdims=True)).astype(float)
    for _ in range(10):
        weight = (weight + 1e-3) / (weight + 1e-3).sum(axis=1, keepdims=True)
        emit = weight.T @ counts + 20 * overall
        emit /= emit.sum(axis=1, keepdims=True)
        prior = weight.mean(axis=0)
        log = counts @ np.log(emit.T) + np.log(prior)
        weight = np.exp(log - log.max(axis=1, keepdims=True))
    return prior, emit.T.copy()


def mixture_counts(sequences: list[np.ndarray], prior: np.ndarray, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected stretches of each state, and expected classes (class, state), if a stretch has one state."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    flat = np.concatenate(sequences)
    first = np.cumsum(lengths) - lengths
    weight = np.stack([np.add.reduceat(column[flat], first) for column in np.log(emit).T.copy()], axis=1) + np.log(prior)
    weight = np.exp(weight - weight.max(axis=1, keepdims=True))
    weight /= weight.sum(axis=1, keepdims=True)
    emits = np.stack([np.bincount(flat, weights=np.repeat(w, lengths), minlength=len(emit)) for w in weight.T], axis=1)
    return weight.sum(axis=0), emits


def _added(data: DataFrame, size: int, count: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray:
    """The sum of ``count`` over the stretches of all rows: added up in tasks, then by Spark; only sums return."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in slices(batch, "classes", 2 << 20, 1 << 30):
                total += count(_sequences(part, STRETCH))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "v"])

    got = data.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(size)
    total[got["i"].to_numpy(np.int64)] = got["v"].to_numpy()
    return total


def first_chain(data: DataFrame, n_classes: int, states: int, seed: int) -> Chain:
    """States from a mixture of class frequencies, fitted to all stretches of all texts; states tend to stay."""
    spark = data.sparkSession
    prior, emit = first_centres(first_stretches(data), n_classes, states, seed)
    for _ in range(MIXTURE_ROUNDS):
        shared = spark.sparkContext.broadcast((prior, emit))

        def count(sequences: list[np.ndarray], shared=shared) -> np.ndarray:
            return np.concatenate([x.ravel() for x in mixture_counts(sequences, *shared.value)])

        total = _added(data, states + n_classes * states, count)
        shared.unpersist()
        weight, emits = total[:states] + 0.1, total[states:].reshape(n_classes, states)
        overall = emits.sum(axis=1, keepdims=True) + 0.1
        emits = emits + 20 * overall / overall.sum()
        prior, emit = weight / weight.sum(), emits / emits.sum(axis=0)
    stay = 0.9
    return Chain(prior, stay * np.eye(states) + (1 - stay) * prior, emit)


def train(encoded: DataFrame, n_classes: int, states: int = STATES, iterations: int = ITERATIONS, seed: int = 11) -> Chain:
    """Baum-Welch over all rows of ``encoded``, whose result does not depend on their layout but for the rounding of sums."""
    spark = encoded.sparkSession
    data = encoded.select("classes")
    chain = first_chain(data, n_classes, states, seed)
    k = states
    for _ in range(iterations):
        shared = spark.sparkContext.broadcast(chain)

        def count(sequences: list[np.ndarray], shared=shared) -> np.ndarray:
            starts, moves, emits, _ = shared.value.expected(sequences)
            return np.concatenate([starts, moves.ravel(), emits.ravel()])

        total = _added(data, k + k * k + n_classes * k, count)
        shared.unpersist()
        starts, moves, emits = total[:k] + 0.1, total[k : k + k * k].reshape(k, k) + 0.1, total[k + k * k :].reshape(n_classes, k)
        overall = emits.sum(axis=1, keepdims=True) + 0.1
        emits = emits + overall / overall.sum()
        chain = Chain(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emits / emits.sum(axis=0))
    return chain


def score_texts(docs: DataFrame, learn: Column, states: int = STATES, iterations: int = ITERATIONS, head: int = HEAD, own_count: int = OWN_COUNT) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of (doc_id, text).

    The model learns from the rows where ``learn`` holds (null: not).  ``base_score`` is the log10 probability of the
    text's tokens under their add-one frequencies, ``score`` under the hidden Markov model, both with one event for
    all words not learned (of each ending class, in the latter).  Null and empty texts are one end token.  If nothing is
    learned, base scores are zero and scores come from uniform classes.  Equal texts get equal scores; other columns
    are ignored; no rows in, no rows out.
    """
    marked = docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn"))
    counts, _ = store(word_counts(marked.where("learn")), "word-counts")
    lex = lexicon(counts, head, own_count)
    encoded, _ = store(encode(marked, lex), "classes")
    chain = train(encoded.where("learn"), lex.n_classes, states, iterations)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    rest = _rest_sums(encoded, counts, lex)
    names = ["uid", "doc_id", "n_tokens", "n_known", "base", "words"]
    kept = encoded.select(*names, "classes")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name in names)

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.select(names).append_column("chain", pa.array(shared.value.forward(_sequences(batch))))

    rows = map_slices(kept, "classes", f"{fields}, chain double", scored, 16 << 20)
    joined = rows.join(rest, "uid", "left")

    def plus(column: str) -> Column:
        return F.col(column) + F.coalesce(F.col(f"rest_{column}"), F.lit(0))

    return joined.select(
        "doc_id", "n_tokens", plus("n_known").cast("long").alias("n_known"), F.lit(lex.total).cast("long").alias("train_tokens"),
        plus("base").alias("base_score"), (F.col("chain") + plus("words")).alias("score"),
    )


def _rest_sums(encoded: DataFrame, counts: DataFrame, lex: Lexicon) -> DataFrame:
    """(uid, rest_n_known, rest_base, rest_words): sums over the words that tasks do not know, from a join with their counts."""
    spark = encoded.sparkSession
    shared = [(e, float(lex.class_tokens[e] + lex.class_rest[e]), float(lex.class_rest[e])) for e in range(ENDING_CLASSES)]
    classes = spark.createDataFrame(shared, "e int, all_tokens double, rest double")
    tail = encoded.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
    found = tail.join(counts, "token", "left").join(F.broadcast(classes), "e", "left")
    c, n = F.coalesce(F.col("c"), F.lit(0)), F.col("n")
    base = F.log10((c + 1) / F.lit(float(lex.total + lex.distinct + 1)))
    words = F.coalesce(F.log10(F.when(c > 0, c).otherwise(F.col("rest")) / F.col("all_tokens")), F.lit(0.0))
    return found.groupBy("uid").agg(
        F.sum(F.when(c > 0, n).otherwise(0)).alias("rest_n_known"), F.sum(n * base).alias("rest_base"), F.sum(n * words).alias("rest_words")
    )
