"""Language identification: family first, then one against one inside the family.

A text is described by its byte 2- and 3-grams, hashed to ``DIMS`` counts over the
whole text, square-rooted and scaled to length 1.  Linear support vector machines
(squared hinge loss) decide between every two families, and inside the winning family
between every two languages; votes win, margins settle ties.

The machines are fitted on a bounded sample: at most ``PER_LANGUAGE`` texts a language,
those with the smallest hash of their id, chosen by Spark with a top-n per language.
Prediction reads every text in full and needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicator_engine.llm.common import pack, release_worker_values, slices, text_bytes, unpack

DIMS = 4096
PER_LANGUAGE = 300
UNDETERMINED = "und"
#: bytes of text described at once
SLAB_BYTES = 4 << 20

# ---- Fixed values: families of common languages (any other is a family of its own)
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "bs"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt", "am"),
}
# ---- end of fixed values

_ASCII_LETTER = re.compile("[A-Za-z]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def _slabs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLAB_BYTES`` each and at most 512 rows."""
    row, n = 0, len(ends) - 1
    while row < n:
        last = int(np.searchsorted(ends, ends[row] + SLAB_BYTES, "right")) - 1
        last = min(max(last, row + 1), row + 512, n)
        yield row, last
        row = last


def _gram_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    rows = len(ends) - 1
    counts = np.zeros(rows * DIMS, np.float32)
    if len(data) < 2:
        return counts.reshape(rows, DIMS)
    byte = _FOLD[data].astype(np.uint32)
    base = np.repeat(np.arange(rows, dtype=np.int64) * DIMS, np.diff(ends))
    for n in (2, 3):
        if len(byte) < n:
            continue
        code = byte[: len(byte) - n + 1] * np.uint32(0x9E3779B1)
        for i in range(1, n):
            code = (code ^ byte[i : len(byte) - n + 1 + i]) * np.uint32(0x85EBCA6B)
        code ^= code >> np.uint32(15)
        inside = base[: len(code)] == base[n - 1 :]
        at = base[: len(code)] + (code & np.uint32(DIMS - 1))
        counts += np.bincount(at[inside], minlength=rows * DIMS).astype(np.float32)
    return counts.reshape(rows, DIMS)


def features(data: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of unit length, slab by slab; a slab longer than the limit is one text, taken in parts."""
    for row, last in _slabs(ends):
        start, stop = ends[row], ends[last]
        if last == row + 1 and stop - start > SLAB_BYTES:
            counts = np.zeros((1, DIMS), np.float32)
            for at in range(start, stop, SLAB_BYTES):
                piece = data[at : min(at + SLAB_BYTES, stop)]
                counts += _gram_counts(piece, np.array([0, len(piece)]))
        else:
            counts = _gram_counts(data[start:stop], ends[row : last + 1] - start)
        counts = np.sqrt(counts)
        yield counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1e-9)


# ---- learning ----------------------------------------------------------------


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a linear machine, squared hinge loss, classes weighted alike; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    w = np.zeros(x.shape[1])
    ahead, t = w.copy(), 1.0
    step = 1.0 / (1.0 + 2 * cost * 2.0)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        grad = ahead - 2 * cost * (x.T @ (share * y * slack))
        new = ahead - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w


class Model:
    """Families, their languages, and a machine for every pair of either."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        of = {lang: family for family, members in FAMILIES.items() for lang in members}
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(labels)):
            self.families.setdefault(of.get(lang, lang), []).append(lang)
        families = np.array([of.get(lang, lang) for lang in labels])
        langs = np.array(labels)
        self.between = self._pairs(x, families, sorted(self.families))
        self.within = {f: self._pairs(x, langs, members) for f, members in self.families.items()}

    @staticmethod
    def _pairs(x: np.ndarray, labels: np.ndarray, classes: list[str]) -> dict[tuple[int, int], np.ndarray]:
        out = {}
        for a, b in combinations(range(len(classes)), 2):
            rows = (labels == classes[a]) | (labels == classes[b])
            out[a, b] = fit_svm(x[rows], np.where(labels[rows] == classes[a], 1.0, -1.0))
        return out

    @staticmethod
    def _vote(x: np.ndarray, machines: dict, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Winner of each row, and the smallest confidence of its duels."""
        votes = np.zeros((len(x), n))
        sure = np.ones((len(x), n))
        for (a, b), w in machines.items():
            margin = x @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(4 * margin, -50, 50)))
            # margins settle ties between equal votes
            votes[:, a] += (margin > 0) + 1e-3 * p
            votes[:, b] += (margin <= 0) + 1e-3 * (1 - p)
            sure[:, a], sure[:, b] = np.minimum(sure[:, a], p), np.minimum(sure[:, b], 1 - p)
        best = votes.argmax(axis=1)
        return best, sure[np.arange(len(x)), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        names = sorted(self.families)
        family, score = self._vote(x, self.between, len(names))
        langs = np.empty(len(x), object)
        for at, name in enumerate(names):
            rows = np.flatnonzero(family == at)
            best, sure = self._vote(x[rows], self.within[name], len(self.families[name]))
            langs[rows] = np.array(self.families[name], object)[best]
            score[rows] = score[rows] * sure
        return list(langs), score


def learn(
    labelled: DataFrame,
    per_language: int = PER_LANGUAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> Model | None:
    """A model from rows with text and language; None if there is none."""
    key = ["_lang", "_order", "_tie"]
    rows = labelled.select(
        F.col(lang_column).cast("string").alias("_lang"),
        F.xxhash64(id_column).alias("_order"),
        F.xxhash64(text_column).alias("_tie"),
        F.col(text_column).cast("string").alias("_text"),
    ).where("_lang IS NOT NULL AND length(_text) > 0")
    top = F.row_number().over(W.partitionBy("_lang").orderBy("_order", "_tie"))
    # hashes are ranked, not texts; at most per_language rows a language are chosen
    chosen = rows.select(*key).withColumn("_rank", top).where(F.col("_rank") <= per_language).select(*key).distinct()
    sample = rows.join(F.broadcast(chosen), key).dropDuplicates(key).select("_lang", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            described = [pack(v.astype("<f4")) for part in features(*text_bytes(batch.column("_text"))) for v in part]
            yield pa.RecordBatch.from_arrays([batch.column("_lang"), pa.array(described, pa.binary())], ["_lang", "_v"])

    # at most per_language rows of 4 * DIMS bytes a language
    table = sample.mapInArrow(run, "_lang string, _v binary").orderBy("_lang", "_v").toArrow()
    if not table.num_rows:
        return None
    x = np.stack([unpack(v, "<f4") for v in table.column("_v").to_pylist()]).astype(np.float64)
    return Model(x, table.column("_lang").to_pylist())


def identify(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    A null text and a text without a letter get ``und`` and score 0, as does every text
    without a model.  Columns of these names are replaced; rows are neither dropped nor
    merged, and an empty table gives no rows.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    at = keep.index(text_column)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_worker_values()
        for batch in slices(batches):
            column = batch.column(at).cast(pa.large_string())
            letters = [has_letter(t) for t in column.to_pylist()]
            langs, scores = [UNDETERMINED] * len(letters), np.zeros(len(letters))
            if model is not None:
                row = 0
                for part in features(*text_bytes(column)):
                    found, sure = model.predict(part)
                    langs[row : row + len(found)], scores[row : row + len(found)] = found, sure
                    row += len(found)
            langs = [lang if ok else UNDETERMINED for lang, ok in zip(langs, letters)]
            scores = np.where(letters, scores, 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return docs.select(*keep).mapInArrow(run, schema)
