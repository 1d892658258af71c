"""Language identification by string kernels.

The kernel of two texts is the blended spectrum of character n-grams (orders 1 to 4) by
presence: for each order, the number of n-grams that both texts hold, over the geometric
mean of what each holds, averaged over the orders. N-grams are taken from the lower-cased
whole text, with everything but letters turned into one blank, and are numbered by a hash
(``FEATURES`` slots per order).

Training: about ``per_label`` labelled rows per language (those whose hash of the identifier lies
under the share that makes so many, and never over twice as many), of which ``landmarks`` span the Nyström space; one kernel ridge regression
per language on +1 and -1. The rows come to the driver as packed presence bits of fixed size,
not as texts. Scoring: presence matrix times landmark matrix times dual weights; as the last
two do not depend on the text, their product is formed once.

Null texts and texts without a letter get ``und`` and score 0. Ties go to the smaller language.
Texts of any length are read whole. Repeated rows are predicted alike. Columns that are called like the added ones (lang_pred, score,
fits) are replaced by them; a caller that needs them renames them before, as the pipeline does.
Without labelled rows every text is ``und``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import uniform_of

FEATURES = (1 << 9, 1 << 11, 1 << 13, 1 << 14)
_STARTS = np.cumsum((0, *FEATURES))
_FACTORS = np.random.default_rng(99).integers(0, 2**63, 4, dtype=np.uint64) | np.uint64(1)
_LETTER: list = []
UNKNOWN = "und"
#: Texts of so few slots (some words) may show their language by a clear lead: a
#: lead of the best margin over the second (2 in a perfect fit) that shows a learned language at three quarters of the norm.
SHORT, CLEAR_LEAD = 128, 2 / 3


def _letters() -> np.ndarray:
    """Whether each code point is a letter, once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def mark_ngrams(text: str | None, row: np.ndarray) -> bool:
    """Set the slots of the text's n-grams in ``row``; False if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return False
    keep = letter.copy()  # the first blank of a run stays
    keep[1:] |= letter[:-1]
    codes = np.where(letter, points, np.uint32(32))[keep].astype(np.uint64)
    codes = np.concatenate(([32], codes, [32])).astype(np.uint64)
    total = np.zeros(len(codes), np.uint64)
    for k, size in enumerate(FEATURES):
        if len(codes) <= k:
            break
        total = total[:len(codes) - k] * _FACTORS[0] + codes[k:] + np.uint64(1)
        slot = (total * _FACTORS[1]) >> np.uint64(64 - (size.bit_length() - 1))
        row[_STARTS[k] + slot.astype(np.int64)] = True
    return True


def scale(presence: np.ndarray) -> np.ndarray:
    """Rows whose dot products are the kernel: each order scaled by its own count."""
    out = presence.astype(np.float32)
    for a, b in zip(_STARTS[:-1], _STARTS[1:], strict=True):
        held = out[:, a:b].sum(axis=1, keepdims=True)
        out[:, a:b] /= np.sqrt(np.maximum(held, 1) * len(FEATURES))
    return out


def training_bits(docs: DataFrame, per_label: int, max_labels: int, id_column: str,
                  text_column: str, label_column: str) -> tuple[list[str], np.ndarray]:
    """Labels and packed presence bits of the bounded training sample."""
    labelled = docs.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("string").alias("name"), F.col(label_column).alias("label"),
        F.col(text_column).alias("text"))
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(max_labels + 1).collect()
    if len(sizes) > max_labels:
        raise ValueError(f"more than {max_labels} languages")
    if not sizes:
        return [], np.empty((0, 0), np.uint8)
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["label"], per_label / r["n"])])
    drawn = labelled.where(uniform_of("name") < share[F.col("label")])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for text in batch.column("text"):
                row = np.zeros(_STARTS[-1], bool)
                packed.append(np.packbits(row).tobytes() if mark_ngrams(text.as_py(), row) else None)
                if packed[-1] is not None:
                    packed[-1] = np.packbits(row).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("label"),
                                              pa.array(packed, pa.binary())], ["name", "label", "bits"])

    rows = (drawn.mapInArrow(bits, "name string, label string, bits binary").where("bits IS NOT NULL")
            .limit(2 * per_label * len(sizes)).collect())
    rows.sort()
    return [r["label"] for r in rows], np.frombuffer(
        b"".join(r["bits"] for r in rows), np.uint8).reshape(len(rows), -1)


def fit(labels: list[str], packed: np.ndarray, landmarks: int, ridge: float, seed: int
        ) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(languages, weight of every n-gram slot for each, intercepts, map into the landmarks' space)."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    truth = np.array(labels)
    quota = -(-landmarks // len(names))
    at = np.sort(np.concatenate([rng.permutation(np.flatnonzero(truth == n))[:quota] for n in names]))
    of = lambda k: scale(np.unpackbits(packed[k], axis=1, count=_STARTS[-1]))
    marks = of(at)
    among = (marks @ marks.T).astype(np.float64)
    power, turn = np.linalg.eigh(among)
    good = power > 1e-6 * power.max()
    whiten = turn[:, good] / np.sqrt(power[good])
    mapped = np.vstack([of(np.arange(k, min(k + 256, len(truth)))) @ marks.T
                        for k in range(0, len(truth), 256)]).astype(np.float64) @ whiten
    share = np.array([1 / (truth == n).sum() for n in truth])
    share /= share.sum()
    centre = share @ mapped
    weighted = (mapped - centre) * share[:, None]
    system = weighted.T @ (mapped - centre) + ridge * np.eye(mapped.shape[1])
    signs = np.where(truth[:, None] == np.array(names), 1.0, -1.0)
    mean = share @ signs
    beta = np.linalg.solve(system, weighted.T @ (signs - mean))
    return (names, (marks.T @ (whiten @ beta)).astype(np.float32), mean - centre @ beta,
            (marks.T @ whiten).astype(np.float32))


def nearness(presence: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots held, norm in the landmarks' space); a text that lies in that space has norm 1."""
    return presence.sum(axis=1), np.linalg.norm(scale(presence) @ space, axis=1)


def least_norms(size: np.ndarray, norm: np.ndarray, group: int = 20, skipped: int = 1,
                slack: float = 0.85) -> tuple[np.ndarray, np.ndarray]:
    """(size, least norm): what texts from that many slots on must reach.

    Labelled rows are grouped by size; the least is ``slack`` times what all but the ``skipped`` lowest
    rows of a whole group reach. Smaller texts never have to reach more than larger ones.
    """
    if not len(size):
        return np.zeros(1, np.int64), np.zeros(1)
    parts = np.array_split(np.argsort(size, kind="stable"), max(len(size) // group, 1))
    least = [slack * np.sort(norm[k])[min(skipped, len(k) // 20)] for k in parts]
    return np.array([size[k].min() for k in parts]), np.minimum.accumulate(least[::-1])[::-1]


def identify_language(docs: DataFrame, training: DataFrame, id_column: str = "doc_id",
                      text_column: str = "text", label_column: str = "lang",
                      per_label: int = 500, landmarks: int = 256, ridge: float = 1e-4,
                      max_labels: int = 200, seed: int = 3, batch: int = 64,
                      keep_text: bool = True, fits: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1) at the end, without the text if not ``keep_text``.

    ``training`` supplies the labelled rows; predictions see the text alone. With ``fits`` a column of
    that name says whether the text fits a learned language: its norm in the landmarks' space reaches what
    labelled rows of its size reach that had no part in the fit (a fourth of each language's sample, which
    is drawn twice as large), or it is short, reaches three quarters and its best margin leads clearly. Neither depends on the number of languages.
    """
    labels, packed = training_bits(training, per_label * (2 if fits else 1), max_labels, id_column, text_column,
                                   label_column)
    space, bounds = None, least_norms(np.zeros(0), np.zeros(0))
    if labels:
        truth, unseen = np.array(labels), np.zeros(len(labels), bool)
        for n in set(labels) if fits else ():
            unseen[np.flatnonzero(truth == n)[3::4]] = True
        names, weights, base, space = fit(truth[~unseen].tolist(), packed[~unseen], landmarks, ridge, seed)
        if unseen.any():
            bounds = least_norms(*np.concatenate([
                nearness(np.unpackbits(packed[unseen][k:k + 256], axis=1, count=_STARTS[-1]), space)
                for k in range(0, int(unseen.sum()), 256)], axis=1))
    else:
        names, weights, base = [UNKNOWN], np.zeros((_STARTS[-1], 1), np.float32), np.array([-1.0])
    model = docs.sparkSession.sparkContext.broadcast((names, weights, base, space if fits else None, bounds))

    added = ["lang_pred", "score", *(["fits"] if fits else [])]
    others = [c for c in docs.columns if c not in (*added, text_column)]
    kept = [c for c in docs.columns if c in (*others, text_column)] if keep_text else others

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights, base, space, (sizes, least) = model.value
        block = np.zeros((batch, _STARTS[-1]), bool)
        for whole in batches:
            best, score, fitting = [], [], []
            texts = whole.column(text_column)
            for k in range(0, len(texts), batch):
                block[:] = False
                some = texts[k:k + batch]
                known = [mark_ngrams(t.as_py(), block[i]) for i, t in enumerate(some)]
                margin = scale(block[:len(some)]) @ weights + base
                first = margin.argmax(axis=1)
                if fits and space is None:
                    fitting += [False] * len(some)
                elif fits:
                    size, norm = nearness(block[:len(some)], space)
                    due = least[np.maximum(np.searchsorted(sizes, size, "right") - 1, 0)]
                    enough = norm >= due
                    if len(names) > 1:
                        two = np.sort(margin, axis=1)[:, -2:]
                        enough |= (size < SHORT) & (two[:, 1] - two[:, 0] >= CLEAR_LEAD) & (norm >= 0.75 * due)
                    fitting += (enough & np.array(known)).tolist()
                for i, ok in enumerate(known):
                    best.append(names[first[i]] if ok else UNKNOWN)
                    score.append(float(np.clip((margin[i, first[i]] + 1) / 2, 0, 1)) if ok else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(whole.column(c) for c in kept), pa.array(best, pa.string()),
                 pa.array(score, pa.float64()), *([pa.array(fitting, pa.bool_())] if fits else [])],
                [*kept, *added])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    if fits:
        schema = schema.add("fits", "boolean")
    return docs.select(*dict.fromkeys((*kept, text_column))).mapInArrow(predict, schema)


def fold_of(id_column: str, folds: int) -> Column:
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(folds))
