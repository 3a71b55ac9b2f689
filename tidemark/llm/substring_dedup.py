"""Repeated passages by content-defined chunking with a gear rolling hash.

A cut is the end of a word whose gear hash, of the last 32 bytes, is the smallest among WINDOW
neighbouring word ends; so cuts move with the text, and an insertion changes those around it only.
The SEED words before a cut are its seed. SEED + WINDOW - 1 = 50 words in a row hold WINDOW word ends
whose seeds lie inside them, so every passage of 50 words or more has a cut and a seed that all
documents with the passage share, whatever stands around it.

Seeds that two documents share only tell where to look: all runs of SEED words up to WINDOW - 1 words
before and after them are then compared over all documents, which gives the bounds of the passages
to the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as w64
from tidemark.llm.common import fresh, scratch, text_key

#: Words of a seed; they have over 32 bytes, all that the gear hash at their end reads.
SEED = 20
#: Word ends of which the smallest hash is a cut.
WINDOW = 31
#: Words of a run from which it counts as a repeated passage. From SEED + WINDOW - 1 words on none is
#: missed; shorter ones, down to SEED words, are found if they hold or lie near a seed that is shared.
MIN_WORDS = 20
_GEAR_SPAN = 32
_BLOCK = 1 << 20
_GEAR = np.random.default_rng(11).integers(0, 2**32, 256, dtype=np.uint32)

SEED_SCHEMA = "doc long, first int, d1 long, d2 int, l long, r long"
RUN_SCHEMA = "doc long, first int, last int, start int, end int, sure boolean, owner long, d1 long, d2 int"


def gear(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of it and the 31 before: sum of table[b] << age, 32 bits."""
    h = _GEAR[data]
    width = 1
    while width < _GEAR_SPAN:
        older = h[:-width] << np.uint32(width)
        h = h.copy()
        h[width:] += older
        width *= 2
    return h


def cuts(text: bytes) -> np.ndarray:
    """Ends of the chunks of a text; the last is its length."""
    words = _Words([text])
    return np.unique(np.append(words.ends[_cuts(words)], len(text)))[0 if text else 1:]


class _Words:
    """The words of some texts: bytes, bounds of the words, the first word of each text, the text of each word."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        after = np.cumsum([len(t) + 1 for t in texts])
        self.begins = np.concatenate([[0], after[:-1]])
        edge = np.diff(np.concatenate([[False], w64.SOLID[self.data]]).astype(np.int8))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.offsets = np.concatenate([[0], np.searchsorted(self.starts, after)])
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.offsets))

    def digests(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits that stand for the bytes from word ``first`` to word ``last``."""
        lo, hi = self.starts[first], self.ends[last]
        two = w64.span_hashes(self.data.astype(np.uint16) + 256, lo, hi) >> np.uint64(32)
        return w64.span_hashes(self.data, lo, hi).view(np.int64), two.astype(np.uint32).view(np.int32)


def _cuts(words: _Words) -> np.ndarray:
    """The last words of chunks. A text with fewer than WINDOW seeds has one cut, at the smallest of all."""
    last = np.flatnonzero(np.arange(len(words.text)) - words.offsets[words.text] >= SEED - 1)
    if not len(last):
        return last
    # Of equal hashes, the later word counts as smaller.
    key = (gear(words.data)[words.ends[last] - 1].astype(np.uint64) << np.uint64(32)) | (np.uint64(2**32 - 1) - last.astype(np.uint64))
    text, low, width = words.text[last], key, 1
    while width < WINDOW and len(low) > 0:
        step = min(width, WINDOW - width)
        low, width = np.minimum(low[:-step], low[step:]), width + step
    whole = text[:len(low)] == text[WINDOW - 1:] if len(low) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(np.diff(text, prepend=-1))
    few = np.diff(np.append(first, len(text))) < WINDOW
    least = np.minimum.reduceat(key, first)[few]
    return (np.uint64(2**32 - 1) - (np.unique(np.concatenate([low[whole], least])) & np.uint64(2**32 - 1))).astype(np.int64)


def seeds(texts: DataFrame) -> DataFrame:
    """One row per cut of ``texts`` (doc, t): first word, digest of the seed, digests with the words before and after it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, doc = pdf["t"].tolist(), pdf["doc"].to_numpy(dtype=np.int64)
            for part in w64.blocks(texts, _BLOCK):
                words = _Words(texts[part])
                last = _cuts(words)
                first, text = last - SEED + 1, words.text[last]
                before = np.maximum(first - WINDOW + 1, words.offsets[text])
                after = np.minimum(last + WINDOW - 1, words.offsets[text + 1] - 1)
                d1, d2 = words.digests(first, last)
                l, r = (w64.span_hashes(words.data, words.starts[lo], words.ends[hi]).view(np.int64) for lo, hi in ((before, last), (first, after)))
                yield pd.DataFrame({"doc": doc[part][text], "first": (first - words.offsets[text]).astype(np.int32), "d1": d1, "d2": d2, "l": l, "r": r})
    return texts.mapInPandas(run, SEED_SCHEMA)


def _runs(marked: DataFrame) -> DataFrame:
    """Runs of words of ``marked`` (doc, t, at, owners) that are repeated (sure, with owner) or may be (SEED words and their digest).

    ``at`` has the first word of each shared seed, times four, plus 2 if the words before it differ
    between its documents and 1 if those after it do; else they are repeated with the seed.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, doc = pdf["t"].tolist(), pdf["doc"].to_numpy(dtype=np.int64)
            for part in w64.blocks(texts, _BLOCK):
                words = _Words(texts[part])
                codes = pdf["at"].iloc[part].tolist()
                code = np.concatenate(codes).astype(np.int64)
                text = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
                seed = words.offsets[text] + (code >> 2)
                left, right = (code & 2) > 0, (code & 1) > 0
                first = np.where(left, seed, np.maximum(seed - WINDOW + 1, words.offsets[text]))
                last = np.where(right, seed + SEED - 1, np.minimum(seed + SEED + WINDOW - 2, words.offsets[text + 1] - 1))
                near = np.arange(1, WINDOW)
                maybe = np.concatenate([(seed[right, None] + near).ravel(), (seed[left, None] - near).ravel()])
                home = np.concatenate([np.repeat(text[right], WINDOW - 1), np.repeat(text[left], WINDOW - 1)])
                maybe = np.unique(maybe[(maybe >= words.offsets[home]) & (maybe + SEED <= words.offsets[home + 1])])
                d1, d2 = words.digests(maybe, maybe + SEED - 1)
                n, m = len(first), len(maybe)
                first, last = np.concatenate([first, maybe]), np.concatenate([last, maybe + SEED - 1])
                text = np.concatenate([text, words.text[maybe]])
                yield pd.DataFrame({
                    "doc": doc[part][text], "first": (first - words.offsets[text]).astype(np.int32), "last": (last - words.offsets[text]).astype(np.int32),
                    "start": (words.starts[first] - words.begins[text]).astype(np.int32), "end": (words.ends[last] - words.begins[text]).astype(np.int32),
                    "owner": np.concatenate([*pdf["owners"].iloc[part], np.zeros(m, dtype=np.int64)]).astype(np.int64),
                    "d1": np.concatenate([np.zeros(n, dtype=np.int64), d1]), "d2": np.concatenate([np.zeros(n, dtype=np.int32), d2]),
                    "sure": np.arange(n + m) < n})
    return marked.mapInPandas(run, RUN_SCHEMA)


def _doc(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), text_key(F.col(text_col)))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per repeated span: _doc (hash of id and text), start, end (bytes in UTF-8), words, copied, cut.

    A run of SEED words is repeated if another document has the same bytes; the document of the
    smallest hash owns it. Runs that overlap or touch are one span. ``copied`` counts the words of
    the runs that others own, ``cut`` lists their bounds. Rows that repeat both id and text are one document.
    """
    texts = docs.select(_doc(id_col, text_col).alias("doc"), F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("t"))
    # Seeds are made twice: that costs less than to write and keep them.
    shared = (seeds(texts).groupBy("d1", "d2").agg(*[f(c).alias(f"{c}_{n}") for c in ("doc", "l", "r") for n, f in (("low", F.min), ("high", F.max))])
              .where("doc_low <> doc_high")
              .select("d1", "d2", F.col("doc_low").alias("owner"), F.expr("int(l_low <> l_high) * 2 + int(r_low <> r_high)").alias("open")))
    found = seeds(texts).select("doc", "first", "d1", "d2").join(shared, ["d1", "d2"])
    marks = (found.select("doc", F.struct((F.col("first") * 4 + F.col("open")).alias("at"), "owner").alias("m")).groupBy("doc").agg(F.collect_set("m").alias("m"))
             .select("doc", F.col("m.at").alias("at"), F.col("m.owner").alias("owners")))
    runs = scratch(_runs(texts.join(marks, "doc")), "repeats-runs")
    # The same run of a row that is there twice has one document, so it is not repeated by that.
    known = (runs.where("not sure").groupBy("d1", "d2").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
             .where("low <> high").select("d1", "d2", "low"))
    more = runs.where("not sure").join(known, ["d1", "d2"]).withColumn("owner", F.col("low"))
    bounds = ["doc", "first", "last", "start", "end", (F.col("doc") != F.col("owner")).alias("copy")]
    rows = runs.where("sure").select(*bounds).unionByName(more.select(*bounds))
    order = Window.partitionBy("doc").orderBy("first", "last", "copy")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    copied = F.when(F.col("copy"), F.col("last"))
    rows = (rows.withColumn("new", F.coalesce(F.col("first") > F.max("last").over(past) + 1, F.lit(True)).cast("int"))
            .withColumn("newcopy", (F.col("copy") & F.coalesce(F.col("first") > F.max(copied).over(past) + 1, F.lit(True))).cast("int"))
            .withColumn("span", F.sum("new").over(order)).withColumn("part", F.when(F.col("copy"), F.sum("newcopy").over(order))))
    ends = [F.min("first").alias("first"), F.max("last").alias("last"), F.min("start").alias("start"), F.max("end").alias("end")]
    parts = rows.groupBy("doc", "span", "part").agg(*ends)
    theirs = F.col("part").isNotNull()
    spans = parts.groupBy("doc", "span").agg(
        *ends[2:], (F.max("last") - F.min("first") + 1).alias("words"), F.sum(F.when(theirs, F.col("last") - F.col("first") + 1).otherwise(0)).alias("copied"),
        F.sort_array(F.collect_list(F.when(theirs, F.struct("start", "end")))).alias("cut"))
    return spans.where(F.col("words") >= min_words).withColumnRenamed("doc", "_doc").drop("span")


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_spans, repeated_words, copied_words, spans, repeated.

    ``spans`` are (start, end) byte bounds of the passages that other documents have too; copied_words
    are those that another document owns. Null and empty texts have none; repeated rows are one
    document and get equal results, so they do not repeat each other; whole copies under another id
    do. Other columns are ignored; an empty table gives no rows.
    """
    spans = repeated_spans(docs, id_col, text_col, min_words)
    each = spans.groupBy("_doc").agg(F.count("*").alias("n_spans"), F.sum("words").alias("repeated_words"), F.sum("copied").alias("copied_words"),
                                     F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    rows = docs.select(
        _doc(id_col, text_col).alias("_doc"), F.col(id_col).alias("id"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return rows.join(each, "_doc", "left").select(
        "id", "n_words", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_spans", "repeated_words", "copied_words")],
        F.coalesce("spans", none).alias("spans"), F.col("n_spans").isNotNull().alias("repeated"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` whose repeated passages stay in the document that owns them and are cut from all others."""
    spans = repeated_spans(docs, id_col, text_col, min_words)
    doc, own, cut = fresh(docs, "doc", "own", "cut")
    each = spans.groupBy(F.col("_doc").alias(doc)).agg(F.flatten(F.collect_list("cut")).alias(cut))

    @F.pandas_udf("string")
    def without(text: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for t, spans in zip(text, cuts):
            if t is not None and spans is not None:
                raw, at, parts = t.encode(), 0, []
                for s in sorted(spans, key=lambda s: s["start"]):
                    parts.append(raw[at:s["start"]])
                    at = s["end"]
                t = b"".join([*parts, raw[at:]]).decode()
            out.append(t)
        return pd.Series(out)
    both = docs.withColumn(own, _doc(id_col, text_col)).join(each, F.col(own) == F.col(doc), "left")
    return both.withColumn(text_col, F.when(F.size(cut) > 0, without(F.col(text_col), F.col(cut))).otherwise(F.col(text_col))).select(*docs.columns)
