"""Quality by compression: which of two zstandard dictionaries makes a text smaller.

One dictionary is trained on good labelled texts, one on bad ones. A text is compressed in pieces of
CHUNK bytes, each with either dictionary, so that a long text cannot serve as its own dictionary; the
difference of the two sizes per byte is calibrated on labelled rows that no dictionary has seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVEL = 3
CHUNK = 512
#: Bytes of a dictionary.
DICTIONARY = 112_640
#: Training sample: texts per class for a dictionary, characters of each (from its middle), texts for the calibration.
DICTIONARY_ROWS, SAMPLE, CALIBRATION_ROWS = 2_000, 8_000, 8_000
#: Texts below these sizes in bytes are calibrated on their own, as far as RIDGE lets them: the less text, the less a difference says.
SHORT = (64, 256)
RIDGE = 0.5
#: Unit of the difference per byte.
_UNIT = 0.02
THRESHOLD = 0.7


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary, or where there is too little to train on, the texts themselves."""
    total = sum(map(len, texts))
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(1024, total // 8)), texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:]


def _compressor(body: bytes) -> zstandard.ZstdCompressor:
    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not body:
        return zstandard.ZstdCompressor(**plain)
    known = zstandard.ZstdCompressionDict(body)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, **plain)


class Sizes:
    """How many bytes more a text takes with the bad dictionary than with the good one."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = _compressor(good), _compressor(bad)

    def of(self, text: str | None) -> tuple[int, int]:
        """The difference, and the bytes of the text."""
        raw = (text or "").encode("utf-8", "surrogatepass")
        more = 0
        for at in range(0, len(raw), CHUNK):
            piece = raw[at:at + CHUNK]
            more += len(self.bad.compress(piece)) - len(self.good.compress(piece))
        return more, len(raw)


def _features(more: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Difference per byte and a constant, for all texts and once more for those of each class of short ones."""
    x = more / np.maximum(size, 1) / _UNIT
    columns, least = [x, np.ones(len(x))], 0
    for edge in SHORT:
        mine = (size >= least) & (size < edge)
        columns += [x * mine, mine.astype(float)]
        least = edge
    return np.stack(columns, axis=1)


def calibrate(more: np.ndarray, size: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method."""
    rows = _features(more, size)
    ridge = np.array([0.01, 0.001, *[RIDGE] * (rows.shape[1] - 2)])
    weights = np.zeros(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        step = np.linalg.solve((rows * (p * (1 - p))[:, None]).T @ rows + np.diag(ridge), rows.T @ (p - y) + ridge * weights)
        # A full step may overshoot where classes are nearly apart.
        weights -= step / max(1.0, float(np.abs(step).max()) / 5)
        if np.abs(step).max() < 1e-9:
            break
    return weights


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray

    def score(self, more: np.ndarray, size: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_features(more, size) @ self.weights, -30, 30)))


def fold(doc_id: Column) -> Column:
    """0 to 3; rows of fold 2 are held out. A null id belongs to no fold and trains nothing."""
    return F.crc32(doc_id.cast("string")) % 4


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Dictionaries and calibration from a bounded sample of labelled rows outside fold 2.

    By a hash of the id, one half of the ids is for dictionaries (DICTIONARY_ROWS of each class), the
    other for the calibration (CALIBRATION_ROWS). An id with several labels has the highest; of
    several texts with one id, the first by order counts. Rows without label or text train nothing.
    With one class only, the score is its share; without any, 0.5.
    """
    spark, h = docs.sparkSession, F.xxhash64("_id")
    known = (labels.where((fold(F.col(id_col)) != 2) & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("_id")).agg((F.max(F.col(label_col).cast("int")) > 0).alias("good")))
    halves = known.where(h % 2 == 0), known.where(h % 2 != 0)

    def texts(pick: DataFrame) -> DataFrame:
        # The ids are bounded by the parameters.
        text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
        return text.join(F.broadcast(pick), "_id")
    picks = [halves[0].where(good).orderBy(h, "_id").limit(DICTIONARY_ROWS) for good in ("good", "not good")]
    middle = F.expr(f"substring(text, greatest(1, CAST((length(text) - {SAMPLE}) / 2 AS INT)), {SAMPLE})")
    taught = texts(picks[0].union(picks[1])).groupBy("_id", "good").agg(F.min(middle).alias("text")).toPandas().sort_values("_id")
    bodies = {good: dictionary([t.encode("utf-8", "surrogatepass") for t in taught["text"][taught["good"] == good]]) for good in (True, False)}
    held = spark.sparkContext.broadcast(bodies)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(held.value[True], held.value[False])
        for pdf in batches:
            told = [sizes.of(t) for t in pdf["text"]]
            yield pd.DataFrame({"_id": pdf["_id"], "good": pdf["good"], "more": [x[0] for x in told], "size": [x[1] for x in told]})
    rows = texts(halves[1].orderBy(h, "_id").limit(CALIBRATION_ROWS)).select(F.col("_id").cast("string").alias("_id"), "good", "text")
    told = rows.mapInPandas(measure, "_id string, good boolean, more long, size long").groupBy("_id", "good")
    seen = told.agg(F.min(F.struct("size", "more")).alias("x")).select("_id", "good", "x.size", "x.more").toPandas().sort_values("_id")
    weights = np.zeros(2 + 2 * len(SHORT))
    n = [int((seen["good"] == good).sum() + (taught["good"] == good).sum()) for good in (False, True)]
    if n[0] and n[1] and len(seen):
        weights = calibrate(seen["more"].to_numpy(dtype=float), seen["size"].to_numpy(), seen["good"].to_numpy(dtype=float))
    elif sum(n):
        weights[1] = np.log((n[1] + 0.5) / (n[0] + 0.5))
    return Model(bodies[True], bodies[False], weights)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, more (bytes the bad dictionary takes more), size (bytes), score (0 to 1, higher is likelier good).

    Null and empty texts have size 0 and get the score of a short text that tells nothing. Rows are
    scored one by one: repeated rows and ids get repeated results, null ids too; other columns are
    ignored; an empty table gives none.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = Sizes(held.value.good, held.value.bad)
        for pdf in batches:
            told = np.array([sizes.of(t) for t in pdf["text"]], dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({"id": pdf["id"], "more": told[:, 0], "size": told[:, 1], "score": held.value.score(told[:, 0], told[:, 1])})
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    told = rows.mapInPandas(run, "id string, more long, size long, score double")
    return told.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
