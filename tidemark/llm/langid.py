"""Language identification by rank-order n-gram profiles and out-of-place distance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fold, fresh

#: Ranks of a profile; a gram that a profile lacks is this far out of place.
PROFILE_SIZE = 400
SEGMENT = 1 << 20
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else a blank."""
    global _letters
    if _letters is None:
        table = np.full(0x110000, 32, dtype=np.uint64)
        for c in range(0x110000):
            if (x := chr(c)).isalpha():
                table[c] = ord(low) if len(low := x.lower()) == 1 else c
        _letters = table
    return _letters


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes and counts of the letter 1-, 2- and 3-grams of a whole text.

    Words are runs of letters with a blank on each side; no gram spans two words.
    """
    table, parts, tail = _letter_table(), [], np.full(1, 32, dtype=np.uint64)
    for at in range(0, max(len(text), 1), SEGMENT):
        piece = text[at:at + SEGMENT].encode("utf-32-le", "surrogatepass")
        end = [np.full(1, 32, dtype=np.uint64)] if at + SEGMENT >= len(text) else []
        c = np.concatenate([tail, table[np.frombuffer(piece, dtype=np.uint32)], *end])
        new = len(tail)
        blank = c == 32
        stay = ~(blank & np.concatenate([[False], blank[:-1]]))
        new = int(stay[:new].sum())  # characters before this one were counted with the segment before
        c = c[stay]
        blank = c == 32
        one = c[new:][~blank[new:]]
        two = (c[:-1] << np.uint64(21) | c[1:])[max(new - 1, 0):]
        three = (c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:])[max(new - 2, 0):]
        three = three[~blank[1:-1][max(new - 2, 0):]]
        parts.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
        tail = c[-2:]
    if len(parts) == 1:
        return parts[0]
    return merge_counts(parts)


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts])).astype(np.int64)


def has_letter(codes: np.ndarray) -> bool:
    return bool(len(codes)) and bool(((codes < 0x110000) & (codes != 32)).any())


def profiles(train: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """Language -> its most frequent grams, by falling count, over all rows of ``train``.

    Rows without text or language are left out. Each task adds up the grams of its rows; the driver
    gets ``size`` grams per language.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            for lang, texts in pdf.groupby("lang")["text"]:
                parts, group, held = [sums[lang]] if lang in sums else [], [], 0
                for t in texts:
                    group.append(t)
                    held += len(t)
                    if held >= SEGMENT:
                        parts.append(gram_counts(" ".join(group)))
                        group, held = [], 0
                if group:
                    parts.append(gram_counts(" ".join(group)))
                sums[lang] = merge_counts(parts)
        for lang, (codes, counts) in sums.items():
            yield pd.DataFrame({"lang": lang, "code": codes.astype(np.int64), "n": counts})

    rows = train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    total = rows.mapInPandas(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = total.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")))
    top = ranked.where(F.col("rank") <= size).select("lang", "rank", "code").collect()
    found: dict[str, list[tuple[int, int]]] = {}
    for r in top:
        found.setdefault(r["lang"], []).append((r["rank"], r["code"]))
    return {lang: np.array([c for _, c in sorted(v)], dtype=np.uint64) for lang, v in sorted(found.items())}


def identify(docs: DataFrame, learned: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
             size: int = PROFILE_SIZE, carry: str | None = None) -> DataFrame:
    """Id, lang_pred and score of each row; with ``carry`` all its columns, and both in a struct of that name.

    The document's ``size`` most frequent grams are ranked; the distance to a language is the sum of
    how far each is out of place in its profile, and the nearest language wins (the first by name in
    a tie). ``score`` is 1 minus that distance over the largest possible one. Text that is null or
    has no letter, or an empty set of profiles, gives ``und`` and score 0. Each row is read on its
    own, so repeated rows and ids get repeated results; other columns are ignored.
    """
    lookup = []
    for lang, codes in learned.items():
        order = np.argsort(codes)
        lookup.append((lang, codes[order], order.astype(np.int64)))

    def judge(text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text) if text else (np.zeros(0, dtype=np.uint64), None)
        if not lookup or not has_letter(codes):
            return "und", 0.0
        best = codes[np.argsort(-counts, kind="stable")[:size]]
        ranks, found = np.arange(len(best)), ("und", 2.0)
        for lang, known, rank in lookup:
            at = np.minimum(np.searchsorted(known, best), len(known) - 1)
            away = np.where(known[at] == best, np.minimum(np.abs(rank[at] - ranks), size), size)
            if (d := float(away.sum()) / (size * len(best))) < found[1]:
                found = lang, d
        return found[0], 1.0 - found[1]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            told = [judge(t) for t in pdf["text"]]
            yield pdf.drop(columns="text").assign(lang_pred=[x[0] for x in told], score=[x[1] for x in told])

    if not carry:
        slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
        told = slim.mapInPandas(run, "id string, lang_pred string, score double")
        return told.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)

    judged = F.pandas_udf(lambda s: pd.DataFrame([judge(t) for t in s], columns=["lang_pred", "score"]),
                          "lang_pred string, score double")
    return docs.withColumn(carry, judged(F.col(text_col)))


def keep_identified(docs: DataFrame, learned: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is ``und``, all columns as they were."""
    (told,) = fresh(docs, "told")
    return identify(docs, learned, text_col=text_col, carry=told).where(F.col(told)["lang_pred"] != "und").drop(told)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> Column:
    return fold(F.col(id_col)) != 1
