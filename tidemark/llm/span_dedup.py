"""Removing sentences that lie in repeated spans of consecutive sentences.

A sentence ends behind ``.``, ``!`` or ``?`` (closing quotes and brackets included) and their full-width forms, at a line break,
and at the first comma or semicolon after ``long_words`` words. A span starts at every sentence and
takes the fewest following sentences, ``min_sentences`` at least, that hold ``min_words`` words;
it is hashed to 128 bits over its words (A-Z lower-cased, white space ignored). All spans of
all documents are joined globally by hash. The first span of a hash is the one in the
smallest identifier (null last), then row, then place; every sentence that another span of the hash covers
is removed. What is left of a text keeps its characters.

With ``cut_window`` all cuts depend on the words near them alone, so that equal runs of words are cut alike
wherever they begin and however their lines break: behind the marks above, and behind the word
of least hash in every ``cut_window`` words without such a mark. Every run of
``min_words + 3 * cut_window - 2`` words then holds a whole span: one that starts within its first
``cut_window`` words and ends before the last ``cut_window - 1``, where words outside could cut differently. The query takes 9
and 25: no run of 50 words that came before stays whole. Up to 24 words at an edge of a run can stay.
Words are parted by ASCII white space; a sign of a script that is written without spaces (see ``ALONE``) is a word by itself.

How spans meet:

* One pass sends the different 64-bit hashes of each task, packed by range, and each range gives back those that occur twice.
* They set the bits of a filter of at most ``FILTER_BITS`` bits, which is broadcast. A second pass sends on only spans
  that pass it, with place and 128-bit hash, to the exact count and join. A full filter only lets more spans pass.
* A second such filter of the rows that lose sentences decides which texts are shuffled to meet their ranges; the
  others stay in their partition.
* A passage that fills a third of the table is one row of the counted side and is split by Spark on the other;
  documents are never paired.

Null and empty texts have no sentences; null stays null. A document shorter than a
span has none and keeps its text. Very long texts are cut as arrays in one task. Repeated rows lose their text to the
first one. An empty table gives no rows. Only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

from .common import id_order
from .shingles import _BLANK, _BYTE, _POWERS, mix

_CLOSERS = np.zeros(256, bool)
_CLOSERS[list(b"\"')]}")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?")] = True
_PAUSES = np.zeros(256, bool)
_PAUSES[list(b",;")] = True
# scripts without spaces between words, as first and last code points: Thai to Lao, Myanmar, Khmer, kana and Han
ALONE = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x312F), (0x3400, 0x9FFF), (0xF900, 0xFAFF),
         (0xFF01, 0xFF9F), (0x20000, 0x3FFFF))
_WIDE_STOPS = (0x3002, 0xFF01, 0xFF0E, 0xFF1F, 0xFF61)
FILTER_BITS = 27
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_INVERSES = tuple(np.uint64(pow(int(b), -1, 2**64)) for b in _BASES)


def units_of_bytes(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, 64-bit hash, code point of a sign by itself or 0) of each word, A-Z lower-cased."""
    byte = np.frombuffer(raw.lower(), np.uint8)
    if not len(byte):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), none
    inside = ~_BLANK[byte]
    begins = inside & ~np.append(False, inside[:-1])
    sign = np.zeros(len(byte) + 1, np.int64)
    if byte.max() >= 0xE0:
        at = np.flatnonzero(byte >= 0xE0)
        wide = byte[at] >= 0xF0
        part = [byte[np.minimum(at + k, len(byte) - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3)]
        point = np.where(wide, (byte[at].astype(np.int64) & 7) << 18 | part[0] << 12 | part[1] << 6 | part[2],
                         (byte[at].astype(np.int64) & 15) << 12 | part[0] << 6 | part[1])
        own = np.zeros(len(at), bool)
        for first, last in ALONE:
            own |= (point >= first) & (point <= last)
        begins[at[own]] = True
        after = at[own] + 3 + wide[own]
        begins[after[after < len(byte)]] |= inside[after[after < len(byte)]]
        sign[at[own]] = point[own]
    start = np.flatnonzero(begins)
    ends = np.append(begins | ~inside, True)
    ends[1:] &= inside
    ends[0] = False
    end = np.flatnonzero(ends)
    _POWERS.to(len(byte) + 1)
    total = np.zeros(len(byte) + 1, np.uint64)
    np.cumsum(_BYTE[byte] * _POWERS.up[:len(byte)], out=total[1:])
    return start, end, mix((total[end] - total[start]) * _POWERS.down[start]), sign[start]


def least_in_windows(words: np.ndarray, stop: np.ndarray, width: int) -> np.ndarray:
    """Whether a word has the least hash (the last of equals) of some ``width`` words without a stop."""
    chosen = np.zeros(len(words), bool)
    if len(words) >= width:
        stops = np.concatenate(([0], np.cumsum(stop)))
        at = np.flatnonzero(stops[width:] == stops[:-width])
        windows = np.lib.stride_tricks.sliding_window_view(words, width)
        for k in range(0, len(at), 1 << 16):
            part = at[k:k + (1 << 16)]
            chosen[part + width - 1 - windows[part, ::-1].argmin(axis=1)] = True
    return chosen


class Sentences:
    """Sentences of one text: first word of each, byte where each begins, word hashes."""

    def __init__(self, text: str | None, long_words: int, cut_window: int | None = None) -> None:
        self.raw = (text or "").encode("utf-8", "surrogatepass")
        start, end, self.words, sign = units_of_bytes(self.raw)
        self.n_words = len(start)
        if not self.n_words:
            self.first, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        byte = np.frombuffer(self.raw, np.uint8)
        last = byte[end - 1]
        closed = _CLOSERS[last] & (end - start > 1)
        stop = _STOPS[np.where(closed, byte[np.maximum(end - 2, 0)], last)] | np.isin(sign, _WIDE_STOPS)
        if cut_window is not None:
            stop |= least_in_windows(self.words, stop, cut_window)
            stop[-1] = True
            self.first = np.concatenate(([0], np.flatnonzero(stop)[:-1] + 1))
            self.begin = start[self.first]
            return
        lines = np.concatenate(([0], np.cumsum(byte == 10)))
        stop[:-1] |= lines[start[1:]] > lines[end[:-1]]
        stop[-1] = True
        ends = np.flatnonzero(stop)
        pauses = np.flatnonzero(_PAUSES[last])
        first = np.concatenate(([0], ends[:-1] + 1))
        extra = []
        for a, b in zip(first[ends - first >= long_words], ends[ends - first >= long_words], strict=True):
            while b - a >= long_words:  # cut at the next pause
                k = np.searchsorted(pauses, a + long_words - 1)
                if k == len(pauses) or pauses[k] >= b:
                    break
                a = pauses[k] + 1
                extra.append(a)
        self.first = np.sort(np.concatenate((first, extra)).astype(np.int64)) if extra else first
        self.begin = start[self.first]

    def spans(self, min_sentences: int, min_words: int) -> tuple[np.ndarray, ...]:
        """(first sentence, sentence behind the last, two hashes) of every span."""
        n = len(self.first)
        edge = np.append(self.first, self.n_words)
        k = np.arange(n)
        after = np.maximum(k + min_sentences, np.searchsorted(edge, edge[:-1] + min_words))
        k, after = k[after <= n], after[after <= n]
        a, b = edge[k], edge[after]
        hashes = []
        for base, inverse in zip(_BASES, _INVERSES, strict=True):
            up = np.cumprod(np.full(self.n_words, base), dtype=np.uint64)
            down = np.cumprod(np.full(self.n_words, inverse), dtype=np.uint64)
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.words * up, dtype=np.uint64)))
            hashes.append(mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)).view(np.int64))
        return k, after, *hashes


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that few spans are held and sent at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def spans_of(batch: pa.RecordBatch, *cuts: int | None) -> Iterator[tuple[np.ndarray, ...]]:
    """(first sentence, sentence behind the last, two hashes) of the spans of each text."""
    min_sentences, min_words, long_words, cut_window = cuts
    for text in batch.column("text"):
        yield Sentences(text.as_py(), long_words, cut_window).spans(min_sentences, min_words)


def repeated_hashes(texts: DataFrame, cuts: tuple, flush: int = 1_000_000) -> DataFrame:
    """h of every 64-bit span hash that occurs twice; written."""
    ranges = 1 << max(0, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    edges = (np.arange(1, ranges, dtype=np.uint64) * np.uint64(2**64 // ranges))

    def packed(hashes: np.ndarray) -> list[bytes]:
        return [x.tobytes() for x in np.split(hashes, np.searchsorted(hashes, edges))]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def out() -> pa.RecordBatch:
            hashes, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(ranges), pa.int32()), pa.array(packed(hashes[times == 1]), pa.binary()),
                 pa.array(packed(hashes[times > 1]), pa.binary())], ["part", "once", "twice"])

        for batch in pieces(batches):
            own = [h for _, _, h, _ in spans_of(batch, *cuts)]
            held += [h.view(np.uint64) for h in own]
            waiting += sum(map(len, own))
            if waiting > flush:
                yield out()
                held, waiting = [], 0
        if held:
            yield out()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, list] = {}
        twice: dict[int, list] = {}
        for batch in batches:  # ranges of one partition are held one beside the other
            for part, one, two in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                once.setdefault(part, []).append(np.frombuffer(one, np.uint64))
                twice.setdefault(part, []).append(np.frombuffer(two, np.uint64))
        for part in once:
            two = np.unique(np.concatenate(twice[part]))
            hashes, times = np.unique(np.concatenate([*once[part], two]), return_counts=True)
            again = np.union1d(hashes[times > 1], two)
            yield pa.RecordBatch.from_arrays([pa.array(again.view(np.int64))], ["h"])

    return materialise(texts.mapInArrow(gather, "part int, once binary, twice binary")
                       .repartition(ranges, "part").mapInArrow(meet, "h bigint"), "repeated")


class HashFilter:
    """Bits set by 64-bit hashes, three each; says of others whether they may be among them."""

    def __init__(self, hashes: DataFrame) -> None:
        (column,) = hashes.columns
        self.bits = bits = min(FILTER_BITS, max(16, (16 * hashes.count()).bit_length()))

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(1 << (bits - 6), np.uint64)
            for batch in batches:
                for word, bit in HashFilter.places(batch.column(0).to_numpy(), bits):
                    np.bitwise_or.at(own, word, bit)
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(own[some].view(np.int64))], ["word", "bit"])

        marked = (hashes.select(column).mapInArrow(mark, "word int, bit bigint")
                  .groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow())
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[marked.column("word").to_numpy()] = marked.column("bit").to_numpy().view(np.uint64)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(3):
            at = mix(hashes.view(np.uint64) + np.uint64(k)) >> np.uint64(64 - bits)
            yield (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for word, bit in self.places(hashes, self.bits):
            out &= self.words[word] & bit != 0
        return out


def passing_spans(rows: DataFrame, cuts: tuple, wanted: HashFilter) -> DataFrame:
    """The spans of all documents whose hash passes the filter, with their place; written."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = list(spans_of(batch, *cuts))
            k, after, one, two = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
            held = np.flatnonzero(shared.value.may_hold(one))
            of_row = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])[held] if found else held
            again = batch.select(["doc_id", "key", "row"]).take(pa.array(of_row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*again.columns, pa.array(k[held], pa.int32()), pa.array(after[held], pa.int32()),
                 pa.array(one[held]), pa.array(two[held])], ["doc_id", "key", "row", "k", "after", "h1", "h2"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return materialise(rows.mapInArrow(
        find, f"doc_id {kinds['doc_id']}, key {kinds['key']}, row bigint, k int, after int, h1 bigint, h2 bigint"), "spans")


def repeated_sentences(spans: DataFrame) -> DataFrame:
    """key and the [k, after) ranges, as k << 32 | after, of sentences that repeat an earlier span; written."""
    place = F.struct(id_order(), F.col("k"))
    # written, so that the join has two plain sides and Spark can split a hash with many spans
    repeated = materialise(
        spans.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .where("n > 1").select("h1", "h2", F.col("first.k").alias("first_k"), F.col("first.col1.row").alias("first_row")), "firsts")
    return materialise(
        spans.select("key", "row", "k", "after", "h1", "h2").join(repeated, ["h1", "h2"])
        .where("row <> first_row OR k <> first_k")
        .groupBy("key").agg(F.collect_set(F.shiftleft(F.col("k").cast("long"), 32) + F.col("after")).alias("ranges")), "ranges")


def span_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               min_sentences: int = 2, min_words: int = 25, long_words: int = 30,
               key: Column | None = None, cut_window: int | None = None) -> DataFrame:
    """doc_id, text without repeated sentences, n_sentences, n_removed, removed and the row key.

    ``removed`` lists [begin, end) in code points of the given text. ``key`` names each row
    again in a second scan (``parquet_row_key``); without it identifiers and texts are written once.
    ``cut_window`` cuts by words alone instead of line breaks and ``long_words``.
    """
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"),
                        *([] if key is None else [key.alias("key")]))
    if key is None:
        plain = materialise(plain.withColumn("key", F.monotonically_increasing_id()), "texts")
    cuts = (min_sentences, min_words, long_words, cut_window)
    wanted = HashFilter(repeated_hashes(plain.select("text"), cuts))
    spans = passing_spans(plain.withColumn("row", F.monotonically_increasing_id()), cuts, wanted)
    ranges = repeated_sentences(spans)
    losing = plain.sparkSession.sparkContext.broadcast(HashFilter(ranges.select(F.xxhash64("key").alias("h"))))
    named = plain.withColumn("h", F.xxhash64("key"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = losing.value.may_hold(batch.column("h").to_numpy())
            yield batch.drop_columns(["h"]).filter(pa.array(held))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            if "h" in batch.schema.names:  # the texts that lose nothing
                batch = batch.filter(pa.array(~losing.value.may_hold(batch.column("h").to_numpy())))
                found: list = [None] * batch.num_rows
            else:
                found = [r.values.to_numpy() if r.is_valid else None for r in batch.column("ranges")]
            out: list[list] = [[], [], [], []]
            for text, ranges in zip(batch.column("text"), found, strict=True):
                text = text.as_py()
                own = Sentences(text, long_words, cut_window)
                n = len(own.first)
                gone = np.zeros(n + 1, np.int64)
                if ranges is not None:
                    gone += np.bincount(ranges >> 32, minlength=n + 1) - np.bincount(ranges & 0xFFFFFFFF, minlength=n + 1)
                gone = np.cumsum(gone)[:n] > 0
                left, removed = _without(own, gone) if gone.any() else (text, [])
                for column, value in zip(out, (left, n, int(gone.sum()), removed), strict=True):
                    column.append(value)
            types = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, types, strict=True)), batch.column("key")],
                ["doc_id", "text", "n_sentences", "n_removed", "removed", "key"])

    met = named.mapInArrow(choose, plain.schema).join(ranges, "key", "left").select(*plain.columns, "ranges")
    kinds = {f.name: f.dataType.simpleString() for f in plain.schema}
    schema = (f"doc_id {kinds['doc_id']}, text string, n_sentences bigint, n_removed bigint, "
              f"removed array<array<bigint>>, key {kinds['key']}")
    return met.mapInArrow(cut, schema).unionByName(named.mapInArrow(cut, schema))


def _without(own: Sentences, gone: np.ndarray) -> tuple[str, list[list[int]]]:
    """The text without the marked sentences, and where they were in code points."""
    begin = own.begin.copy()
    begin[0] = 0  # white space before the first sentence goes with it
    edge = np.append(begin, len(own.raw))
    turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    bounds = edge[turn].reshape(-1, 2)
    kept, at = [], 0
    for a, b in bounds.tolist():
        kept.append(own.raw[at:a])
        at = b
    kept.append(own.raw[at:])
    points = np.concatenate(([0], np.cumsum((np.frombuffer(own.raw, np.uint8) & 0xC0) != 0x80)))
    return b"".join(kept).decode("utf-8", "surrogatepass"), points[bounds].tolist()
