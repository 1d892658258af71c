"""Scoring texts with a hidden Markov language model.

Tokens are words (A-Z lower-cased) and one end per text. The model emits classes: each of at most
``own_classes`` words that are most frequent in training texts is a class, the end is one, and the other words fall
into ``suffix_classes`` by a hash of their last three bytes. Within a suffix class a word has
probability (c + 1) / (N_class + V_class + 1) from its training count, so that any unseen
word has a share. So

    log10 P(text) = log10 P_hmm(classes) + sum over suffix words of log10 P(word | class).

* Counting: one pass counts every word of all texts (batch by batch), and Spark sums them: the table grows with the corpus.
* Words are looked up in a broadcast dictionary of at most ``known_words`` frequent ones, counted over all texts, and the own
  classes; every other occurrence is joined with the table of counts. As frequent words are all in the
  dictionary, no key of that join is hot. What the dictionary holds has no part in the scores: these depend on
  training counts alone.
* Baum-Welch: each round every partition runs scaled forward and backward recursions over its
  whole training texts, many at a time, and emits expected counts; Spark sums them per class. Long texts
  are taken in blocks of tokens, and the state is carried over their edges both ways. Only sums of fixed size come to the driver.
* Scoring runs the scaled forward recursion exactly over each whole text.

Null texts are empty: the end alone. Very long texts need memory for one block of states. Rows with a null fold count as
training. Repeated rows are scored one by one. Words of equal counts are all own classes or none. Without
training rows every class is equally likely. An empty table gives no rows. Only the named columns are read, so other columns
may have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

END = 0  # class of the end of a text
SUFFIX = 3  # bytes


def words_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(words of each text, different words with A-Z in lower case, which of these each word is); some may be equal or empty."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    found = split.flatten().dictionary_encode()
    different = [w.lower() for w in found.dictionary.cast(pa.binary()).to_pylist()]
    number = found.indices.to_numpy()
    n_words = pc.list_value_length(split).to_numpy()
    blank = np.array([not w for w in different], bool)
    if blank.any():  # what white space at an end of a text leaves
        kept = ~blank[number]
        before = np.concatenate(([0], np.cumsum(kept)))
        ends = np.cumsum(n_words)
        n_words, number = before[ends] - before[ends - n_words], number[kept]
    return n_words, different, number


def count_words(rows: DataFrame) -> DataFrame:
    """word, c (in training texts), c_all of every word; written."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, different, number = words_of(batch.column("text"))
            training = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool), n_words)
            both = [np.bincount(x, minlength=len(different)) for x in (number[training], number)]
            some = np.flatnonzero(both[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([different[k] for k in some], pa.binary()), *(pa.array(x[some]) for x in both)], ["word", "c", "c_all"])

    return materialise(
        rows.mapInArrow(count, "word binary, c bigint, c_all bigint")
        .groupBy("word").agg(F.sum("c").alias("c"), F.sum("c_all").alias("c_all")), "words")


def most_frequent(counts: DataFrame, limit: int, by: str) -> DataFrame:
    """The words whose count ``by`` is above the lowest (in steps of 2 percent) that at most ``limit`` words reach.

    The threshold comes from a histogram of some hundred rows, so no task sends its own
    ``limit`` words anywhere.
    """
    counts = counts.where(F.col(by) > 0)
    level = F.floor(F.log(by) / math.log(1.02))
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    total, lowest = 0, None
    for row in levels:
        total += row["n"]
        if total > limit:
            break
        lowest = row["level"]
    return counts.where(level >= lowest) if lowest is not None else counts.limit(0)


class Vocabulary:
    """What the encoder needs of the counts; its size is bounded by the parameters."""

    def __init__(self, counts: DataFrame, train_texts: int, own_classes: int, suffix_classes: int,
                 known_words: int) -> None:
        whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
        self.train_tokens = whole["n"] + train_texts
        self.distinct = whole["v"] + (train_texts > 0)
        self.train_texts = train_texts
        self.own, self.suffixes = own_classes, suffix_classes
        if 1 + own_classes + suffix_classes > 1 << 16:
            raise ValueError("class numbers have 16 bits")
        own = {bytes(r["word"]): r["c"] for r in most_frequent(counts, own_classes, "c").collect()}
        known = {bytes(r["word"]): r["c"] for r in most_frequent(counts, known_words, "c_all").collect()}
        by_suffix = {r["suffix"]: (r["n"], r["v"]) for r in counts.groupBy(
            F.pmod(F.crc32(F.substring("word", -SUFFIX, SUFFIX)), F.lit(suffix_classes)).alias("suffix"))
            .agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).collect()}
        room = np.ones(suffix_classes)
        for suffix, (n, v) in by_suffix.items():
            room[suffix] += n + v
        self.classes = 1 + own_classes + suffix_classes
        self.unigram = np.zeros(self.classes)
        self.unigram[END] = train_texts
        #: word: class (0 for words of a suffix class), training count
        self.known: dict[bytes, tuple[int, int]] = {word: (0, c) for word, c in known.items()}
        for k, (word, c) in enumerate(sorted(own.items(), key=lambda x: (-x[1], x[0]))):
            self.known[word] = (k + 1, c)
            room[self.suffix(word)] -= c + 1
            self.unigram[k + 1] = c
        self.unigram[1 + own_classes:] = room - 1
        self.log_room = np.log10(room)

    def suffix(self, word: bytes) -> int:
        return zlib.crc32(word[-SUFFIX:]) % self.suffixes


def encode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Classes of each text, sums over its known words, and its other words; written."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        # class, log10(c + 1), whether c > 0, log10 P(word | class) without what is to be joined
        table: dict[bytes, tuple[int, float, int, float]] = {}
        for word, (own, c) in v.known.items():
            log_c = math.log10(c + 1)
            suffix = v.suffix(word)
            table[word] = (own, log_c, int(c > 0), 0.0) if own else (
                1 + v.own + suffix, log_c, int(c > 0), log_c - float(v.log_room[suffix]))
        end = (END, math.log10(v.train_texts + 1), int(v.train_texts > 0), 0.0)
        for batch in batches:
            n_words, different, number = words_of(batch.column("text"))
            hits = []
            for w in different:
                hit = table.get(w)
                if hit is None:
                    suffix = v.suffix(w)
                    hit = (1 + v.own + suffix, 0.0, 0, -float(v.log_room[suffix]))
                hits.append(hit)
            rare = np.array([w not in table for w in different], bool)
            ids, logs, seen, inner = (np.array(x) for x in zip(*hits, end, strict=True))
            after = np.cumsum(n_words)
            tokens = np.insert(number, after, len(different))  # the end behind each text
            n_tokens = n_words + 1
            begin = np.cumsum(n_tokens) - n_tokens
            flat = ids[tokens].astype(np.uint16)
            bounds = np.append(begin, len(flat)).astype(np.int32)
            odd = rare[number]
            of_text = np.concatenate(([0], np.cumsum(odd)))[np.concatenate(([0], after))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "held_out", "row")),
                 pa.Array.from_buffers(pa.binary(), len(n_tokens), [None, pa.py_buffer(2 * bounds), pa.py_buffer(flat)]),
                 pa.array(n_tokens.astype(np.int64)),
                 *(pa.array(np.add.reduceat(x[tokens], begin).astype(kind) if len(begin) else np.zeros(0, kind))
                   for x, kind in ((seen, np.int64), (logs, np.float64), (inner, np.float64))),
                 pa.ListArray.from_arrays(pa.array(of_text), pa.array(different, pa.binary()).take(pa.array(number[odd])))],
                ["doc_id", "held_out", "row", "classes", "n_tokens", "n_known", "log_counts", "log_inner", "rare"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return materialise(rows.mapInArrow(
        encode_batches, f"doc_id {kind}, held_out boolean, row bigint, classes binary, n_tokens bigint, "
        "n_known bigint, log_counts double, log_inner double, rare array<binary>"), "encoded")


class Model:
    """Start, transition and emission probabilities (emission as classes x states)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def seeded(cls, unigram: np.ndarray, states: int, seed: int) -> Model:
        """States that differ from the class frequencies by seeded noise, and tend to stay."""
        rng = np.random.default_rng(seed)
        emit = (unigram + 0.5)[:, None] * rng.uniform(0.25, 1.75, (len(unigram), states))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Model:
        """Maximum likelihood with a little of the prior class distribution in every state."""
        emit = emit + prior[:, None]
        move = move + 0.1
        start = start + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def expected_counts(model: Model, texts: list[np.ndarray], steps: int = 1024, width: int = 512):
    """Baum-Welch counts (start, move, emit) and log-likelihood of whole texts.

    ``width`` texts of about one length go side by side. Longer ones than ``steps`` tokens are run forward once to
    keep the state before each block of so many tokens, and then block by block from the last, forward and back.
    """
    states = len(model.start)
    start, move, emit = (x.astype(np.float32) for x in (model.start, model.move, model.emit))
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((len(emit), states))
    likelihood = 0.0
    texts = sorted(texts, key=len, reverse=True)
    for k in range(0, len(texts), width):
        own = texts[k:k + width]
        n = np.array([len(t) for t in own])
        flat = np.concatenate(own).astype(np.int64)
        begin = np.cumsum(n) - n

        def forward(first: int, alpha: np.ndarray, keep: bool, n=n, flat=flat, begin=begin):
            """A block from the state before it: tokens, active texts, scales and states of every step."""
            last = min(first + steps, int(n[0]))
            m = int((n > first).sum())
            active = np.searchsorted(-n, -np.arange(first, last), "left")
            seen = flat[np.minimum(begin[:m] + np.arange(first, last)[:, None], len(flat) - 1)]
            p = emit[seen]
            held = np.zeros_like(p) if keep else None
            scales = np.ones((last - first, m), np.float32)
            for t, a in enumerate(active.tolist()):
                state = p[t, :a] * (start if first + t == 0 else alpha[:a] @ move)
                scales[t, :a] = state.sum(axis=1)
                state /= scales[t, :a, None]
                alpha = state
                if keep:
                    held[t, :a] = state
            return seen, active, p, scales, held, alpha

        before = [np.zeros((len(own), states), np.float32)]
        for first in range(0, int(n[0]) - steps, steps):
            before.append(forward(first, before[-1], False)[-1])
        beta = np.ones((len(own), states), np.float32)
        for first in range((len(before) - 1) * steps, -1, -steps):
            earlier = before.pop()
            seen, active, p, scales, held, _ = forward(first, earlier, True)
            posterior = np.zeros_like(held)
            for t in range(len(active) - 1, -1, -1):
                a = active[t]
                posterior[t, :a] = held[t, :a] * beta[:a]
                if first + t:
                    onward = p[t, :a] * beta[:a] / scales[t, :a, None]
                    moves += (held[t - 1] if t else earlier)[:a].T @ onward
                    beta[:a] = onward @ move.T
            if first == 0:
                starts += posterior[0].sum(axis=0)
            for s in range(states):
                emits[:, s] += np.bincount(seen.ravel(), posterior[:, :, s].ravel(), len(emits))
            likelihood += float(np.log10(scales).sum(dtype=np.float64))
    return starts, moves * model.move, emits, likelihood


def train(encoded: DataFrame, vocabulary: Vocabulary, states: int, rounds: int, seed: int
          ) -> tuple[Model, list[float]]:
    """The model after ``rounds`` of Baum-Welch over all training texts, and its likelihoods."""
    spark = encoded.sparkSession
    prior = (vocabulary.unigram + 0.5) / (vocabulary.unigram + 0.5).sum() * 20
    model = Model.seeded(vocabulary.unigram, states, seed)
    history = []
    training = encoded.where("NOT held_out").select("classes")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                texts = [np.frombuffer(x, np.uint16) for x in batch.column("classes").to_pylist()]
                own = expected_counts(shared.value, texts)
                total = own if total is None else tuple(a + b for a, b in zip(total, own, strict=True))
            if total is None:
                return
            start, move, emit, likelihood = total
            held = np.flatnonzero(emit.any(axis=1))
            ids = np.concatenate((held, -1 - np.arange(states), [-1 - states, -2 - states]))
            rest = np.full((1, states), likelihood / states)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *np.vstack((emit[held], move, start[None], rest)).T],
                ["id", *(f"s{k}" for k in range(states))])

        names = [f"s{k}" for k in range(states)]
        summed = (training.mapInArrow(sums, "id bigint, " + ", ".join(f"{n} double" for n in names))
                  .groupBy("id").agg(*(F.sum(n).alias(n) for n in names)).toPandas())
        shared.unpersist()
        if summed.empty:
            break
        table = dict(zip(summed["id"].tolist(), summed[names].to_numpy(), strict=True))
        emit = np.zeros((vocabulary.classes, states))
        for c, row in table.items():
            if c >= 0:
                emit[c] = row
        move = np.vstack([table[-1 - s] for s in range(states)])
        history.append(float(table[-2 - states].sum()))
        model = Model.from_counts(table[-1 - states], move, emit, prior)
    return model, history


def log_likelihoods(model: Model, texts: list[np.ndarray], block: int = 512) -> np.ndarray:
    """log10 P of each whole sequence of classes, by the scaled forward recursion."""
    lengths = np.array([len(t) for t in texts])
    out = np.zeros(len(texts))
    order = np.argsort(-lengths, kind="stable")
    for k in range(0, len(order), block):
        own = order[k:k + block]
        n = lengths[own]
        flat = np.concatenate([texts[i] for i in own]).astype(np.int64)
        begin = np.cumsum(n) - n
        active = np.searchsorted(-n, -np.arange(int(n[0])), "left")
        alpha = np.broadcast_to(model.start, (len(own), len(model.start)))
        total = np.zeros(len(own))
        for t in range(int(n[0])):
            m = active[t]
            alpha = model.emit[flat[begin[:m] + t]] * (alpha[:m] if t == 0 else alpha[:m] @ model.move)
            scale = alpha.sum(axis=1)
            alpha /= scale[:, None]
            total[:m] += np.log10(scale)
        out[own] = total
    return out


def score_texts(docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text",
                states: int = 8, rounds: int = 6, own_classes: int = 1 << 14,
                suffix_classes: int = 1 << 10, known_words: int = 1 << 17, seed: int = 17) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model learns from the rows whose ``held_out`` is false or null.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_column).alias("text"))
    counts = count_words(plain.select("held_out", "text"))
    train_texts = plain.where("NOT held_out").count()
    vocabulary = Vocabulary(counts, train_texts, own_classes, suffix_classes, known_words)
    encoded = encode(plain.withColumn("row", F.monotonically_increasing_id()), vocabulary)
    model, _ = train(encoded, vocabulary, states, rounds, seed)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(x, np.uint16) for x in batch.column("classes").to_pylist()]
            kept = [c for c in batch.schema.names if c != "classes"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(log_likelihoods(shared.value, texts))],
                [*kept, "log_hmm"])

    summed = ["doc_id", "held_out", "row", "n_tokens", "n_known", "log_counts", "log_inner"]
    scored = encoded.select(*summed, "classes").mapInArrow(
        forward, encoded.select(*summed).schema.add("log_hmm", "double"))
    joined = (encoded.select("row", F.explode("rare").alias("word"))
              .groupBy("row", "word").agg(F.count(F.lit(1)).alias("times"))
              .join(counts.where("c > 0").select("word", "c"), "word")
              .groupBy("row").agg(F.sum("times").alias("more_known"),
                                  F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_log")))
    more_known, more_log = (F.coalesce(c, F.lit(0)) for c in ("more_known", "more_log"))
    base = math.log10(vocabulary.train_tokens + vocabulary.distinct + 1)
    return scored.join(joined, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more_known).alias("n_known"),
        F.lit(vocabulary.train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + more_log - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("log_hmm") + F.col("log_inner") + more_log).alias("score"))
