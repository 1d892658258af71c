"""Aligning the tokens of two tokenizers over the same bytes of a corpus.

Tokenizer A is byte-level, B has pieces with a space sign and byte fallback. Both are given the text behind one
space, and every token is a range of its bytes. Where both end a token a group ends; two occurrences are linked
where their ranges overlap. The ends of both cut a text into stretches that each lie in one token of
A and one of B, and each link is one stretch.

* Identity map: an array gives for each A id the B id of the same bytes. A group of one token on each
  side is (all but always) such a pair. These pairs, wherever they are linked, are counted in vectors as long as
  the vocabulary; only other pairs, from irregular groups, enter a shuffle.
* The count of a pair is the number of texts that hold it linked. The highest count of each A id, the counts of
  identity pairs and those of at most ``known_pairs`` frequent other pairs are broadcast (sizes fixed by vocabulary and
  parameter); all other occurrences are joined with the table of counts. Frequent pairs are all in the
  broadcast, so no key of that join is hot.
* A text is cut before spaces and line feeds that follow no white space. No token of either vocabulary and no piece of A's
  splitting pattern reaches over such a place, so tokens there are those of the whole text; each different chunk is
  encoded and aligned once and kept by its Python worker up to ``CACHED_CHUNKS``. If one of the vocabularies has a
  token over such a place, or a chunk does not give back its bytes, the text is encoded whole.

Texts that are null or empty, or whose tokens of A or of B do not join to the bytes of the space and the text, have no
tokens: zeros and an empty ``groups_sha256``. Very long texts are aligned in one task as arrays. Repeated rows count as
texts of their own; null identifiers stay. Ties of counts are all best. An empty table gives no rows. Only the two named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import math
import os
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

CACHED_CHUNKS = 500_000
TOGETHER = 256  # new chunks in one call of a tokenizer
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
LINKS = ("same", "same_times", "pairs", "pair_times")
KEPT = ("doc_id", "row", *COUNTS, "groups_sha256")
PLAIN = re.compile(r"\s*\S+|\s+")
OTHER_SPACE = re.compile(r"[^\S \n]")
CUT = re.compile(r"(?<=\S)(?=[ \n])")
_ALIGNERS: dict = {}  # a Python worker keeps what it has learned for its next task


def byte_of_sign() -> dict[str, int]:
    """The byte behind each sign of a byte-level vocabulary: printable ones stand for themselves, others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokens:
    """Ids of both tokenizers, the bytes of each id, and the identity map."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        signs = byte_of_sign()
        with open(a_path) as saved:
            vocabulary = json.load(saved)["model"]["vocab"]
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in vocabulary.items():
            self.a_bytes[k] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.b_bytes = []
        for k in range(self.b.vocab_size()):
            piece = self.b.id_to_piece(k)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        of_bytes = {x: k for k, x in enumerate(self.b_bytes) if self.b.is_byte(k)}
        of_bytes |= {x: k for k, x in reversed(list(enumerate(self.b_bytes))) if not self.b.is_byte(k)}
        self.same = np.array([of_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        over = re.compile(r"\S[ \n]")
        self.local = not any(over.search(x.decode(errors="replace")) for x in (*self.a_bytes, *self.b_bytes))
        self.lead = len(self.b.encode("a"))

    def whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of a space and the text, and of B of the text (B puts the space before it)."""
        return (np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int64),
                np.array(self.b.encode(text), np.int64))

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that begin at a place where tokens end, behind the word ``a`` that is taken off again."""
        text = "a" + "".join(texts)
        a, b = self.whole(text)
        first = np.searchsorted(np.cumsum(self.a_size[a]), 2)
        return a[first + 1:], b[self.lead:]

    def gives_back(self, raw: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        return all(b"".join(map(of.__getitem__, ids.tolist())) == raw
                   for of, ids in ((self.a_bytes, a), (self.b_bytes, b)))


class Alignment:
    """Groups and links of the ids of some texts in a row; ``ends`` are the ends of the texts in bytes."""

    def __init__(self, tokens: Tokens, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> None:
        a_end, b_end = np.cumsum(tokens.a_size[a]), np.cumsum(tokens.b_size[b])
        stretch = np.union1d(a_end, b_end)
        #: one code a << 32 | b for each link, in text order
        self.codes = (a[np.searchsorted(a_end, stretch)] << 32) | b[np.searchsorted(b_end, stretch)]
        cuts = np.intersect1d(a_end, b_end)
        self.n_a, self.n_b, self.n_groups, self.n_links = (
            np.diff(np.searchsorted(x, ends, "right"), prepend=0) for x in (a_end, b_end, cuts, stretch))
        # a1,a2|b1;a3|b2 : the tokens of a group in their order, each with the sign behind it
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        written: list = [""] * (len(a) + len(b))
        for ids, group, at, last in ((a, a_group, a_at, "|"), (b, b_group, b_at, ";")):
            closes = np.append(group[1:] != group[:-1], True)
            for k, place, closing in zip(ids.tolist(), at.tolist(), closes.tolist(), strict=True):
                written[place] = f"{k}{last}" if closing else f"{k},"
        after = np.cumsum(self.n_a + self.n_b).tolist()
        self.groups = ["".join(written[x:y])[:-1].encode() for x, y in zip([0, *after[:-1]], after, strict=True)]


class Aligner:
    """Aligns texts chunk by chunk, each different chunk once."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.tokens = Tokens(a_path, b_path)
        self.place: dict[str, int] = {}
        self.groups: list[bytes | None] = []  # None: the chunk does not give back its bytes
        self.sizes = np.zeros((1 << 16, 4), np.int64)
        self.starts = np.zeros(1, np.int64)
        self.codes = np.zeros(1 << 20, np.int64)

    def _forget(self, kept: int) -> None:
        """Keep the chunks that came first: frequent ones came early."""
        self.place = dict(islice(self.place.items(), kept))
        self.groups = self.groups[:kept]
        self.starts = self.starts[:kept + 1].copy()

    def _keep(self, chunks: list[str], found: Alignment | None) -> None:
        """Add chunks whose links are consecutive in ``found``; without it chunks that cannot be aligned."""
        n, held, end = len(chunks), len(self.groups), int(self.starts[-1])
        self.place.update(zip(chunks, range(held, held + n), strict=True))
        if held + n > len(self.sizes):
            self.sizes = np.concatenate((self.sizes, np.zeros((len(self.sizes) + n, 4), np.int64)))
        if found is None:
            self.groups += [None] * n
            self.starts = np.append(self.starts, np.full(n, end))
            return
        self.groups += found.groups
        self.sizes[held:held + n] = np.column_stack((found.n_a, found.n_b, found.n_groups, found.n_links))
        if end + len(found.codes) > len(self.codes):
            self.codes = np.concatenate((self.codes[:end], np.empty(2 * (end + len(found.codes)), np.int64)))
        self.codes[end:end + len(found.codes)] = found.codes
        self.starts = np.append(self.starts, end + np.cumsum(found.n_links))

    def _learn(self, chunks: list[str]) -> None:
        """Encode and align new chunks; those that end in white space, or spoil a joined call, alone."""
        alone = [c for c in chunks if c[-1].isspace()]
        rest = [c for c in chunks if not c[-1].isspace()]
        parts: list[tuple[list[str], np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(0, len(rest), TOGETHER):
            own = rest[k:k + TOGETHER]
            a, b = self.tokens.joined(own)
            raw = [c.encode("utf-8", "surrogatepass") for c in own]
            if self.tokens.gives_back(b"".join(raw), a, b):
                parts.append((own, a, b, np.array([len(x) for x in raw])))
            else:
                alone += own
        bad = []
        for chunk in alone:
            a, b = self.tokens.joined([chunk])
            raw = chunk.encode("utf-8", "surrogatepass")
            if self.tokens.gives_back(raw, a, b):
                parts.append(([chunk], a, b, np.array([len(raw)])))
            else:
                bad.append(chunk)
        if parts:
            own, a, b, sizes = zip(*parts, strict=True)
            self._keep([c for x in own for c in x],
                       Alignment(self.tokens, np.concatenate(a), np.concatenate(b), np.cumsum(np.concatenate(sizes))))
        self._keep(bad, None)

    def _whole(self, text: str) -> tuple | None:
        a, b = self.tokens.whole(text)
        raw = (" " + text).encode("utf-8", "surrogatepass")
        if not self.tokens.gives_back(raw, a, b):
            return None
        found = Alignment(self.tokens, a, b, np.array([len(raw)]))
        return (found.n_a[0], found.n_b[0], found.n_groups[0], found.n_links[0]), found.groups[0], found.codes

    def __call__(self, texts: list[str | None]) -> list[tuple | None]:
        """(n_a, n_b, n_groups, n_links), groups, link codes of each text; None for one without tokens."""
        if not self.tokens.local:
            return [self._whole(t) if t else None for t in texts]
        split = [(CUT.split if OTHER_SPACE.search(t) else PLAIN.findall)(" " + t) if t else [] for t in texts]
        if len(self.groups) > CACHED_CHUNKS:
            self._forget(CACHED_CHUNKS // 2)
        if new := set().union(*split).difference(self.place):
            self._learn(list(new))
        out: list[tuple | None] = []
        for text, chunks in zip(texts, split, strict=True):
            if not chunks:
                out.append(None)
                continue
            at = np.fromiter(map(self.place.__getitem__, chunks), np.int64, len(chunks))
            groups = [self.groups[k] for k in at.tolist()]
            if None in groups:
                out.append(self._whole(text))
                continue
            start, size = self.starts[at], self.sizes[at]
            links = size[:, 3]
            ends = np.cumsum(links)
            take = np.arange(ends[-1]) + np.repeat(start - (ends - links), links)
            out.append((tuple(size.sum(axis=0).tolist()), b";".join(groups), self.codes[take]))
        return out


def aligner_of(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


def slices_of(texts: list[str | None], characters: int = 1 << 21) -> Iterator[slice]:
    """Slices of about so many characters."""
    begin = total = 0
    for k, text in enumerate(texts):
        if k > begin and total + len(text or "") > characters:
            yield slice(begin, k)
            begin, total = k, 0
        total += len(text or "")
    if begin < len(texts):
        yield slice(begin, len(texts))


def aligned_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts of every text, its groups (digest) and its different links with how often each occurs; written.

    ``same`` are A ids of identity pairs, ``pairs`` codes of the others, both as little-endian 64-bit integers.
    """
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in slices_of(texts):
                rows = []
                for found in aligner(texts[part]):
                    if found is None:
                        rows.append((0, 0, 0, 0, "", b"", b"", b"", b""))
                        continue
                    sizes, groups, codes = found
                    codes, times = np.unique(codes, return_counts=True)
                    same = aligner.tokens.same[codes >> 32] == codes & 0xFFFFFFFF
                    rows.append((*map(int, sizes), sha256(groups).hexdigest(), (codes[same] >> 32).tobytes(),
                                 times[same].tobytes(), codes[~same].tobytes(), times[~same].tobytes()))
                kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 4
                own = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays(
                    [own.column("doc_id"), own.column("row"),
                     *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True))],
                    ["doc_id", "row", *COUNTS, "groups_sha256", *LINKS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialise(docs.mapInArrow(
        align, f"doc_id {kind}, row bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
        + ", groups_sha256 string, " + ", ".join(f"{c} binary" for c in LINKS)), "aligned")


def _numbers(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int64) for x in column.to_pylist()]


def pair_counts(aligned: DataFrame, vocabulary: int, flush: int = 2_000_000) -> DataFrame:
    """same (identity pair or not), code (A id, or code of the pair) and n texts; written."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, held, waiting = np.zeros(vocabulary, np.int64), [], 0

        def out(is_same: bool, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), is_same)), pa.array(codes), pa.array(n)],
                                              ["same", "code", "n"])

        for batch in batches:
            for own in _numbers(batch.column("same")):
                same[own] += 1  # the ids of a text are different
            held += _numbers(batch.column("pairs"))
            waiting += sum(map(len, held[-batch.num_rows:]))
            if waiting > flush:
                yield out(False, *np.unique(np.concatenate(held), return_counts=True))
                held, waiting = [], 0
        if waiting:
            yield out(False, *np.unique(np.concatenate(held), return_counts=True))
        some = np.flatnonzero(same)
        yield out(True, some, same[some])

    return materialise(aligned.select("same", "pairs").mapInArrow(count, "same boolean, code bigint, n bigint")
                       .groupBy("same", "code").agg(F.sum("n").alias("n")), "pairs")


def frequent_pairs(counts: DataFrame, limit: int) -> DataFrame:
    """Pairs above the lowest count (in steps of 2 percent) that at most ``limit`` pairs reach."""
    level = F.floor(F.log("n") / math.log(1.02))
    total, lowest = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("pairs")).collect(), reverse=True):
        total += row["pairs"]
        if total > limit:
            break
        lowest = row["level"]
    return counts.where(level >= lowest) if lowest is not None else counts.limit(0)


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text",
                 known_pairs: int = 1 << 18) -> DataFrame:
    """One row per text: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest count of its A id), count_sum
    (counts of the pairs of all links) and groups_sha256.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"),
                        F.monotonically_increasing_id().alias("row"))
    aligned = aligned_texts(plain, a_path, b_path)
    tokens = Tokens(a_path, b_path)
    vocabulary = len(tokens.a_bytes)
    counts = pair_counts(aligned, vocabulary)
    a_id = F.when(F.col("same"), F.col("code")).otherwise(F.shiftright("code", 32))
    best, same = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, np.int64)
    for row in counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("n"), F.max(F.when(F.col("same"), F.col("n"))).alias("same")).collect():
        best[row["a"]], same[row["a"]] = row["n"], row["same"] or 0
    others = counts.where("NOT same").select("code", "n")
    known = frequent_pairs(others, known_pairs).toPandas().sort_values("code")
    shared = spark.sparkContext.broadcast((best, same, known["code"].to_numpy(np.int64), known["n"].to_numpy(np.int64)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, same, codes, counts = shared.value
        for batch in batches:
            rows = []
            for ids, id_times, pairs, times in zip(*(_numbers(batch.column(c)) for c in LINKS), strict=True):
                n_best = int(id_times[same[ids] == best[ids]].sum())
                total = int((id_times * same[ids]).sum())
                at = np.searchsorted(codes, pairs)
                at[at == len(codes)] = 0
                hit = codes[at] == pairs if len(codes) else np.zeros(len(pairs), bool)
                n = counts[at[hit]]
                n_best += int(times[hit][n == best[pairs[hit] >> 32]].sum())
                total += int((times[hit] * n).sum())
                left = ~hit
                rows.append((n_best, total, pairs[left], times[left], best[pairs[left] >> 32]))
            columns = zip(*rows, strict=True) if rows else [()] * 5
            kinds = [pa.int64()] * 2 + [pa.list_(pa.int64())] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in KEPT), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                [*KEPT, "n_best", "count_sum", "code", "times", "best"])

    kept = {f.name: f.dataType.simpleString() for f in aligned.schema}
    scored = aligned.mapInArrow(
        score, ", ".join(f"{c} {kept[c]}" for c in KEPT)
        + ", n_best bigint, count_sum bigint, code array<bigint>, times array<bigint>, best array<bigint>")
    rare = (scored.select("row", F.explode(F.arrays_zip("code", "times", "best")).alias("link"))
            .select("row", "link.code", "link.times", "link.best").join(others, "code")
            .groupBy("row").agg(F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    done = scored.drop("code", "times", "best").join(rare, "row", "left").select(
        "doc_id", *COUNTS, *((F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
                             for c, more in (("n_best", "more_best"), ("count_sum", "more_sum"))), "groups_sha256")
    return done
