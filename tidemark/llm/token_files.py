"""Token ids in flat binary files that are read by memory mapping.

A data set is a folder of segments in ascending identifier order:

* ``NNNNNN.ids``: the token ids as little-endian unsigned integers, of 16 bits if the
  vocabulary has at most 65,536 ids, else of 32;
* ``NNNNNN.offsets``: little-endian unsigned 64-bit integers, one more than documents: where
  each document's ids begin in the whole data set, and the end of the segment;
* ``NNNNNN.docs``: the identifiers as little-endian signed 64-bit integers;
* ``segments.json``: for each segment its base, its documents (without an identifier, and all) and its ids.

Segments come from one range partitioning by identifier. A task streams its documents
into files under a name of its own and renames them when it is done, so a repeated task
writes the same files again. Bases are prefix sums of the segments' counts: only one row per
segment comes to the driver.

The folder must be a path that all executors and readers have mounted (memory mapping needs
files); a ``file:`` prefix is allowed. Null text is empty: a document of the end id alone.
Null identifiers come first, and ``segments.json`` says how many documents of a segment have none; equal
identifiers keep all their rows, ordered by a hash of the text. A very long text is encoded alone. An empty table gives a folder
of empty segments. Only the two named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHED_WORDS = 1_200_000
_ENCODERS: dict = {}  # a Python worker keeps what it has learned for its next task


def local_path(folder: str) -> str:
    """The mounted path of ``folder``."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    if "://" in folder:
        raise ValueError(f"memory-mapped files need a mounted folder, not {folder}")
    return folder


class WordEncoder:
    """Encodes texts word by word, each new word once by the tokenizer (in lower case if it folds case itself).

    Only for tokenizers that never join characters across white space and drop white space
    themselves (word_bpe_49k is one). ``separator`` is a sign with an id of its own that stands
    between the words of one call; words that hold it are encoded alone. Without it texts
    are encoded whole.
    """

    def __init__(self, tokenizer_path: str, separator: str | None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.kind = id_kind(self.tokenizer.get_vocab_size())
        saved = json.loads(self.tokenizer.to_str())
        normalizer = saved["normalizer"] or {}
        steps = [n for n in normalizer.get("normalizers", [normalizer]) if n]
        self.folds = any(n["type"] == "Lowercase" for n in steps)
        # words of ASCII in lower case are left as they are by these steps
        still = all(n["type"] in ("NFC", "Lowercase") or n.get("pattern") == {"Regex": r"\s+"} for n in steps)
        self.plain = Tokenizer.from_str(json.dumps(saved | {"normalizer": None})) if self.folds and still else self.tokenizer
        self.separator = separator
        if separator is not None:
            (self.between,) = self._encode([separator])[0].tolist()
        self.place: dict[bytes, int] = {}
        self.ids = np.empty(1 << 20, self.kind)
        self.starts = np.zeros(1, np.int64)

    def _encode(self, texts: list[str], plain: bool = False) -> list[np.ndarray]:
        tokenizer = self.plain if plain else self.tokenizer
        return [np.array(x.ids, self.kind) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        """Append the ids of new words to the flat table."""
        sign = self.separator.encode()
        odd = [w for w in words if sign in w or b"<|" in w]  # or a special token
        words = [w for w in words if sign not in w and b"<|" not in w]
        words.sort(key=bytes.isascii)
        others = sum(not w.isascii() for w in words)
        parts, counts = [], []
        for own_words, plain in ((words[:others], False), (words[others:], True)):
            joined = [f" {self.separator} ".join(w.decode() for w in own_words[k:k + 256])
                      for k in range(0, len(own_words), 256)]
            for own in self._encode(joined, plain):
                at = np.flatnonzero(own == self.between)
                counts.append(np.diff(np.concatenate(([-1], at, [len(own)]))) - 1)
                parts.append(np.delete(own, at))
        for own in self._encode([w.decode() for w in odd]):
            counts.append([len(own)])
            parts.append(own)
        new = np.concatenate(parts)
        self.place.update(zip(words + odd, range(len(self.place), len(self.place) + len(words) + len(odd)),
                              strict=True))
        end = int(self.starts[-1])
        if end + len(new) > len(self.ids):
            self.ids = np.concatenate((self.ids[:end], np.empty(2 * (end + len(new)), self.kind)))
        self.ids[end:end + len(new)] = new
        self.starts = np.concatenate((self.starts, end + np.cumsum(np.concatenate(counts))))

    def __call__(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with the end id behind each, ids of each text)."""
        if self.separator is None:
            own = [np.append(x, self.kind(end_id)) for x in self._encode(texts)]
            return np.concatenate(own), np.array([len(x) for x in own])
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        n_words = pc.list_value_length(split).to_numpy()
        found = split.flatten().dictionary_encode()
        words = found.dictionary.cast(pa.binary()).to_pylist()
        if self.folds:  # but for special tokens, which do not fold
            words = [w if b"<|" in w else w.lower() for w in words]
        if len(self.place) > CACHED_WORDS:  # words that are frequent came early
            kept = CACHED_WORDS // 2
            self.place = dict(islice(self.place.items(), kept))
            self.starts = self.starts[:kept + 1].copy()
        if new := list(set(words).difference(self.place)):
            self._learn(new)
        place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))[found.indices.to_numpy()]
        size = self.starts[place + 1] - self.starts[place]
        before = np.concatenate(([0], np.cumsum(size)))
        ends = before[np.cumsum(n_words)]
        take = np.arange(before[-1]) + np.repeat(self.starts[place] - before[:-1], size)
        return (np.insert(self.ids[take], ends, self.kind(end_id)),
                np.diff(np.concatenate(([0], ends))) + 1)


def encoder_of(tokenizer_path: str, separator: str | None) -> WordEncoder:
    if (tokenizer_path, separator) not in _ENCODERS:
        _ENCODERS[tokenizer_path, separator] = WordEncoder(tokenizer_path, separator)
    return _ENCODERS[tokenizer_path, separator]


def id_kind(vocabulary: int) -> type:
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def groups_of(texts: list[str], characters: int = 1 << 23) -> Iterator[slice]:
    """Slices of about so many characters, a longer text alone."""
    begin = total = 0
    for k, text in enumerate(texts):
        if k > begin and total + len(text) > characters:
            yield slice(begin, k)
            begin, total = k, 0
        total += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                      id_column: str = "doc_id", text_column: str = "text",
                      segments: int | None = None, separator: str | None = None) -> DataFrame:
    """Write the data set; returns its segments (segment, base, n_null, n_docs, n_ids)."""
    spark = docs.sparkSession
    segments = segments or int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = local_path(folder)
    os.makedirs(root, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path, separator)
        task = TaskContext.get()
        segment = task.partitionId()
        target = f"{root}/{segment:06d}"
        part = f"{root}/.{segment:06d}-{task.taskAttemptId()}"
        n_docs = n_null = n_ids = 0
        with open(f"{part}.ids", "wb") as ids, open(f"{part}.lengths", "wb") as lengths, \
                open(f"{part}.docs", "wb") as names:
            for batch in batches:
                texts = [t or "" for t in batch.column("text").to_pylist()]
                for part_of in groups_of(texts):
                    own, sizes = encoder(texts[part_of], end_id)
                    ids.write(own.astype(encoder.kind().dtype.newbyteorder("<")).tobytes())
                    lengths.write(sizes.astype("<u8").tobytes())
                    n_ids += len(own)
                name = batch.column("doc_id")
                names.write(pc.fill_null(name, 0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs += batch.num_rows
                n_null += name.null_count
        for kind in ("ids", "lengths", "docs"):
            os.replace(f"{part}.{kind}", f"{target}.{kind}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()) for n in (segment, n_null, n_docs, n_ids)], ["segment", "n_null", "n_docs", "n_ids"])

    ordered = (docs.select(F.col(id_column).cast("long").alias("doc_id"),
                           F.col(text_column).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange(segments, "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie").drop("tie"))
    counts = sorted(ordered.mapInArrow(write, "segment bigint, n_null bigint, n_docs bigint, n_ids bigint").collect())
    bases = np.cumsum([0, *(row["n_ids"] for row in counts)]).tolist()
    table = spark.createDataFrame(
        [(row["segment"], base, row["n_null"], row["n_docs"], row["n_ids"])
         for row, base in zip(counts, bases, strict=False)],
        "segment bigint, base bigint, n_null bigint, n_docs bigint, n_ids bigint")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                target = f"{root}/{row['segment']:06d}"
                lengths = np.fromfile(f"{target}.lengths", "<u8")
                part = f"{target}.offsets-{TaskContext.get().taskAttemptId()}"
                np.concatenate(([0], np.cumsum(lengths)), dtype="<u8", casting="unsafe") \
                    .__iadd__(np.uint64(row["base"])).tofile(part)
                os.replace(part, f"{target}.offsets")
            yield batch

    placed = sorted(table.repartition(max(1, len(counts))).mapInArrow(place, table.schema).collect())
    manifest = f"{root}/segments.json"
    vocabulary = WordEncoder(tokenizer_path, None).tokenizer.get_vocab_size()
    with open(f"{manifest}.new", "w") as out:
        json.dump({"bits": 8 * id_kind(vocabulary)().itemsize,
                   "segments": [row.asDict() for row in placed]}, out)
    os.replace(f"{manifest}.new", manifest)
    for name in os.listdir(root):  # lengths, and parts of attempts that did not end
        if name.endswith(".lengths") or name.startswith(".") or ".offsets-" in name:
            os.remove(f"{root}/{name}")
    return spark.createDataFrame(placed, table.schema)


def _manifest(root: str) -> tuple[str, list[dict]]:
    with open(f"{root}/segments.json") as saved:
        manifest = json.load(saved)
    return f"<u{manifest['bits'] // 8}", manifest["segments"]


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files by memory mapping."""
    root = local_path(folder)
    kind, rows = _manifest(root)
    table = spark.createDataFrame([(row["segment"], row["n_null"]) for row in rows], "segment bigint, n_null bigint")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, n_null in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                target = f"{root}/{segment:06d}"
                offsets = np.fromfile(f"{target}.offsets", "<u8")
                names = np.fromfile(f"{target}.docs", "<i8")
                if not len(names):
                    continue
                ids = np.memmap(f"{target}.ids", kind, "r")
                ends = (offsets - offsets[0]).astype(np.int64)
                sums = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, mask=np.arange(len(names)) < n_null), pa.array(offsets[:-1].astype(np.int64)),
                     pa.array(np.diff(ends)), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return table.repartition(max(1, len(rows))).mapInArrow(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def documents_of_segment(folder: str, segment: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of one segment, for a loader on one machine."""
    target = f"{local_path(folder)}/{segment:06d}"
    offsets = np.fromfile(f"{target}.offsets", "<u8")
    names = np.fromfile(f"{target}.docs", "<i8")
    kind, rows = _manifest(local_path(folder))
    n_null = next(row["n_null"] for row in rows if row["segment"] == segment)
    ids = np.memmap(f"{target}.ids", kind, "r") if len(names) else np.empty(0, kind)
    for k, name in enumerate(names.tolist()):
        a, b = (int(x - offsets[0]) for x in offsets[k:k + 2])
        yield (None if k < n_null else name), ids[a:b]
