"""Benchmark decontamination over a positional inverted index of the training words.

The index is dealt by document: each row is a block of documents with, for every term, the sorted
places (document in block, word position) of its occurrences. A phrase is found inside a block by
intersecting the offset-adjusted lists of its terms, rarest term first, so no posting ever leaves
its block and a word that a third of all documents use costs no more than its own list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w64
from tidemark.llm.common import keep_rows, scratch, text_key

WINDOW = 13
#: Bytes of text in a block of the index.
BLOCK_BYTES = 1 << 20
#: Items whose windows one pass holds in each task; a larger benchmark takes more passes.
ITEMS_PER_PASS = 50_000
_BITS = np.int64(32)

INDEX_SCHEMA = "ids array<string>, keys array<binary>, n_words array<long>, terms array<long>, counts array<int>, docs array<int>, positions array<int>"


def vocabulary(items: DataFrame, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the distinct words of the test texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            hashes, _ = w64.word_hashes(pdf["t"].tolist(), w64.ALNUM)
            yield pd.DataFrame({"term": np.unique(hashes).view(np.int64)})
    rows = items.select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8").alias("t"))
    found = rows.mapInPandas(run, "term long").distinct().toPandas()["term"].to_numpy(dtype=np.int64)
    return np.sort(found.view(np.uint64))


def build_index(docs: DataFrame, terms: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings of ``docs`` by block, of the given terms or of all words, written to the shared folder.

    A null text has no words. Rows are indexed one by one, so repeated ids and rows stay apart.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["t"].tolist()
            for part in w64.blocks(texts, BLOCK_BYTES):
                hashes, offsets = w64.word_hashes(texts[part], w64.ALNUM)
                n = np.diff(offsets)
                doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
                pos = (np.arange(len(hashes)) - offsets[:-1][doc]).astype(np.int32)
                if terms is not None:
                    at = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
                    held = np.flatnonzero(terms[at] == hashes) if len(terms) else np.zeros(0, dtype=np.int64)
                    hashes, doc, pos = hashes[held], doc[held], pos[held]
                order = np.argsort(hashes, kind="stable")
                hashes, doc, pos = hashes[order], doc[order], pos[order]
                known, counts = np.unique(hashes, return_counts=True)
                yield pd.DataFrame({
                    "ids": [pdf["id"].iloc[part].tolist()], "keys": [pdf["key"].iloc[part].tolist()], "n_words": [n],
                    "terms": [known.view(np.int64)], "counts": [counts.astype(np.int32)], "docs": [doc], "positions": [pos]})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("t"))
    return scratch(rows.mapInPandas(run, INDEX_SCHEMA), "postings")


def frequencies(index: DataFrame) -> dict[int, int]:
    """How often each indexed term occurs; as many entries as the index has terms."""
    pair = F.explode(F.arrays_zip("terms", "counts")).alias("p")
    total = index.select(pair).groupBy("p.terms").agg(F.sum("p.counts").alias("n")).toPandas()
    return dict(zip(total["terms"].tolist(), total["n"].tolist()))


class Phrases:
    """Distinct phrases of a set of items, with the order in which to intersect their terms."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, frequency: dict[int, int]):
        hashes, offsets = w64.word_hashes([t for _, t in items], w64.ALNUM)
        owners: dict[bytes, set[str]] = {}
        for k, (item, _) in enumerate(items):
            own = hashes[offsets[k]:offsets[k + 1]]
            for at in range(max(len(own) - window, 0) + 1 if len(own) else 0):
                owners.setdefault(own[at:at + window].tobytes(), set()).add(item)
        self.terms, self.owners = [], []
        for raw, who in owners.items():
            term = np.frombuffer(raw, dtype=np.int64)
            seen = [frequency.get(x, 0) for x in term.tolist()]
            if min(seen):
                self.terms.append((term, np.argsort(seen, kind="stable")))
                self.owners.append(sorted(who))
        self.rarest = np.array([t[o[0]] for t, o in self.terms], dtype=np.int64)


def _places(row, terms: np.ndarray) -> dict[int, np.ndarray]:
    """Term -> its places in the block as document << 32 | position."""
    known = np.asarray(row.terms, dtype=np.int64)
    ends = np.cumsum(np.asarray(row.counts, dtype=np.int64))
    place = np.asarray(row.docs, dtype=np.int64) << _BITS | np.asarray(row.positions, dtype=np.int64)
    wanted = np.flatnonzero(np.isin(known, terms))
    return {int(known[i]): place[ends[i - 1] if i else 0:ends[i]] for i in wanted}


def _near(candidates: np.ndarray, listed: np.ndarray, slop: int) -> np.ndarray:
    """Which candidates have an entry of the sorted list within ``slop``."""
    if not len(listed):
        return np.zeros(len(candidates), dtype=bool)
    at = np.searchsorted(listed, candidates - slop)
    return (at < len(listed)) & (listed[np.minimum(at, len(listed) - 1)] <= candidates + slop)


def find(row, phrases: Phrases, slop: int = 0) -> Iterator[tuple[int, np.ndarray]]:
    """(phrase, starts) of the phrases that the block holds; starts are document << 32 | position.

    With ``slop`` 0 the words follow each other exactly. Otherwise each word may be up to ``slop``
    places away from where the rarest word puts it.
    """
    if not len(phrases.rarest):
        return
    present = np.isin(phrases.rarest, np.asarray(row.terms, dtype=np.int64))
    chosen = np.flatnonzero(present)
    if not len(chosen):
        return
    places = _places(row, np.unique(np.concatenate([phrases.terms[k][0] for k in chosen])))
    none = np.zeros(0, dtype=np.int64)
    for k in chosen:
        term, order = phrases.terms[k]
        starts = places[int(term[order[0]])] - order[0]
        starts = starts[(starts & np.int64(0xFFFFFFFF)) + order[0] < np.int64(1) << _BITS] if slop else starts
        for i in order[1:]:
            starts = starts[_near(starts + i, places.get(int(term[i]), none), slop)]
            if not len(starts):
                break
        if len(starts):
            yield int(k), starts


def search(index: DataFrame, items: list[tuple[str, bytes]], window: int = WINDOW, slop: int = 0,
           frequency: dict[int, int] | None = None) -> DataFrame:
    """One row per match: id, key, item_id, start, kind (phrase, or proximity where slop > 0 and words moved)."""
    phrases = Phrases(items, window, frequency or frequencies(index))
    held = index.sparkSession.sparkContext.broadcast(phrases)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                exact = {k: set(s.tolist()) for k, s in find(row, held.value)} if slop else None
                rows = []
                for k, starts in find(row, held.value, slop):
                    for s in starts.tolist():
                        kind = "phrase" if exact is None or s in exact.get(k, ()) else "proximity"
                        rows += [(row.ids[s >> 32], row.keys[s >> 32], i, s & 0xFFFFFFFF, kind) for i in held.value.owners[k]]
                if rows:
                    yield pd.DataFrame(rows, columns=["id", "key", "item_id", "start", "kind"])
    return index.mapInPandas(run, "id string, key binary, item_id string, start long, kind string")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: id, key, n_words, n_hit, items, contaminated.

    Words are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. An item's
    windows are its runs of ``window`` consecutive words, or all its words if it has fewer. A
    document word is hit if it lies in an occurrence of any window; ``items`` are the ids of items
    with an occurring window, sorted as strings. Contaminated: a word is hit and at least one in
    twenty are. Null and empty texts, of either table, have no words and match nothing; repeated
    rows and ids give repeated results; items with equal ids count as one; a null item id is left
    out of ``items`` but its hits count. Other columns are ignored.
    """
    spark = docs.sparkSession
    terms = vocabulary(benchmark, item_text)
    index = build_index(docs, terms, id_col, text_col)
    frequency = frequencies(index)
    tests = benchmark.select(F.col(item_col).cast("string").alias("i"),
                             F.encode(F.coalesce(F.col(item_text).cast("string"), F.lit("")), "utf-8").alias("t"))
    passes, held = [], []
    for r in tests.toLocalIterator():
        held.append((r["i"], bytes(r["t"])))
        if len(held) == ITEMS_PER_PASS:
            passes.append(spark.sparkContext.broadcast(Phrases(held, window, frequency)))
            held = []
    if held or not passes:
        passes.append(spark.sparkContext.broadcast(Phrases(held, window, frequency)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                n = len(row.ids)
                starts, lengths, items = [], [], [set() for _ in range(n)]
                for part in passes:
                    phrases = part.value
                    for k, found in find(row, phrases):
                        starts.append(found)
                        lengths.append(np.full(len(found), len(phrases.terms[k][0])))
                        for d in np.unique(found >> _BITS).tolist():
                            items[d].update(phrases.owners[k])
                hit = np.zeros(n, dtype=np.int64)
                if starts:
                    begin = np.concatenate(starts)
                    end = begin + np.concatenate(lengths)
                    order = np.argsort(begin, kind="stable")
                    begin, end = begin[order], np.maximum.accumulate(end[order])
                    # Words of a span that no earlier span has covered.
                    new = end - np.maximum(begin, np.concatenate([[0], end[:-1]]))
                    np.add.at(hit, begin >> _BITS, np.maximum(new, 0))
                words = np.asarray(row.n_words, dtype=np.int64)
                yield pd.DataFrame({"id": row.ids, "key": row.keys, "n_words": words, "n_hit": hit,
                                    "items": [sorted(x for x in s if x is not None) for s in items],
                                    "contaminated": (hit > 0) & (20 * hit >= words)})
    told = index.mapInPandas(run, "id string, key binary, n_words long, n_hit long, items array<string>, contaminated boolean")
    return told.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, all columns as they were; rows that repeat id and text become one."""
    clean = contamination(docs, benchmark, id_col, text_col).where("not contaminated")
    return keep_rows(docs, clean.groupBy("id", "key").agg(F.count("*").alias("copies")), id_col, text_col)
