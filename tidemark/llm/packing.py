"""Packing of tokenised documents into fixed-length sequences by length patterns.

Few-document patterns over a grid of lengths are enumerated, a non-negative least-squares fit gives
their repeat counts for the corpus' length histogram, the counts are rounded down, and what is left
is placed by best fit, largest first, into the free ends and into new sequences. All of this works
on counts per length, of which there are no more than the sequence has tokens; documents themselves
only ever meet the finished plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch
from tidemark.llm.tokens import encoder

CAPACITY = 4096
EOS = 1
GRID = 256
PARTS = 3
#: Rows of one length that one window task ranks.
RANK_CELL = 250_000


class Slot(NamedTuple):
    """``count`` pieces of one length, ranks from ``rank``, go to sequences from ``sequence`` at ``offset``."""
    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def patterns(grid: int, parts: int) -> list[tuple[int, ...]]:
    """All ways to fill ``grid`` cells with at most ``parts`` documents, largest first."""
    found: list[tuple[int, ...]] = []

    def extend(prefix: tuple[int, ...], left: int) -> None:
        if left == 0:
            found.append(prefix)
        elif len(prefix) < parts:
            for x in range(min(left, prefix[-1] if prefix else left), 0, -1):
                extend((*prefix, x), left - x)
    extend((), grid)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by the active-set method."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    tol = 1e-9 * max(1.0, float(np.abs(a.T @ b).max()))
    for _ in range(rounds):
        w = np.where(active, -np.inf, a.T @ (b - a @ x))
        best = int(w.argmax())
        if w[best] <= tol:
            break
        active[best] = True
        while True:
            z = np.zeros_like(x)
            z[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            if (z[active] > 0).all():
                break
            bad = active & (z <= 0)
            step = (x[bad] / np.maximum(x[bad] - z[bad], 1e-300)).min()
            x = x + step * (z - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
        x = np.where(active, z, 0.0)
    return x


class _Open:
    """Runs of equal sequences, found by their free space."""

    def __init__(self, capacity: int):
        self.capacity, self.by_slack, self.slacks = capacity, {}, []

    def add(self, slack: int, start: int, count: int) -> None:
        if count and slack:
            if slack not in self.by_slack:
                insort(self.slacks, slack)
                self.by_slack[slack] = []
            self.by_slack[slack].append((start, count))

    def take(self, length: int) -> tuple[int, int, int] | None:
        """The tightest run with room for ``length``: slack, start, count."""
        at = bisect_left(self.slacks, length)
        if at == len(self.slacks):
            return None
        slack = self.slacks[at]
        runs = self.by_slack[slack]
        start, count = runs.pop()
        if not runs:
            del self.by_slack[slack]
            self.slacks.pop(at)
        return slack, start, count


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grid: int = GRID, parts: int = PARTS) -> list[Slot]:
    """Slots for all pieces of a length histogram; no sequence holds more than ``capacity``."""
    slots: list[Slot] = []
    left = {n: c for n, c in histogram.items() if c}
    rank = dict.fromkeys(left, 0)
    opened, sequences = _Open(capacity), 0

    def put(length: int, count: int, sequence: int, offset: int) -> None:
        slots.append(Slot(length, rank[length], count, sequence, offset))
        rank[length] += count
        left[length] -= count

    step = -(-capacity // grid)
    cells = -(-capacity // step)
    want = np.zeros(cells)
    for n, c in left.items():
        want[-(-n // step) - 1] += c
    shapes = patterns(cells, parts)
    a = np.zeros((cells, len(shapes)))
    for k, shape in enumerate(shapes):
        for x in shape:
            a[x - 1, k] += 1
    fit = nnls(a, want) if want.any() else np.zeros(len(shapes))
    # Largest lengths of a cell first, so that small ones remain to fill the free ends.
    queue = {x: sorted((n for n in left if -(-n // step) == x), reverse=True) for x in range(1, cells + 1)}
    have = want.astype(np.int64)
    for k in np.argsort(-fit, kind="stable"):
        repeat = int(fit[k])
        for x in set(shapes[k]):
            repeat = min(repeat, int(have[x - 1]) // shapes[k].count(x))
        if repeat <= 0:
            continue
        edges, runs = {0, repeat}, []
        for x in shapes[k]:
            have[x - 1] -= repeat
            at, run = 0, []
            while at < repeat:
                n = queue[x][0]
                take = min(left[n], repeat - at)
                run.append((at, n))
                left[n] -= take
                at += take
                edges.add(at)
                if not left[n]:
                    queue[x].pop(0)
            runs.append(run)
        marks = sorted(edges)
        for lo, hi in zip(marks, marks[1:]):
            offset = 0
            for run in runs:
                n = next(n for at, n in reversed(run) if at <= lo)
                slots.append(Slot(n, rank[n], hi - lo, sequences + lo, offset))
                rank[n] += hi - lo
                offset += n
            opened.add(capacity - offset, sequences + lo, hi - lo)
        sequences += repeat
    for n in sorted(left, reverse=True):
        while left[n]:
            if (run := opened.take(n)) is not None:
                slack, start, count = run
                fill = min(count, left[n])
                put(n, fill, start, capacity - slack)
                opened.add(slack - n, start, fill)
                opened.add(slack, start + fill, count - fill)
                continue
            each = capacity // n
            full, rest = divmod(left[n], each)
            for count, copies in ((full, each), (1 if rest else 0, rest)):
                if count:
                    for i in range(copies):
                        put(n, count, sequences, i * n)
                    opened.add(capacity - copies * n, sequences, count)
                    sequences += count
    return slots


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece; ``ids`` (little-endian uint32) on demand."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        end = np.array([EOS], dtype="<u4").tobytes()
        width = 4 * capacity
        for pdf in batches:
            texts = pdf["text"].tolist()
            for lo in range(0, len(texts), 512):
                rows = []
                for doc, ids in zip(pdf["doc_id"].iloc[lo:lo + 512], enc.encode(texts[lo:lo + 512])):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), width)):
                        part = ids[at:at + width]
                        rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), *([part] if with_ids else [])))
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = rows.mapInPandas(cut, "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
    return made.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Every document is its token ids and an end id; a null or empty text is the end id alone. Only
    documents longer than ``capacity`` are cut, into full pieces and one shorter last piece. Repeated
    rows and ids are packed as often as they occur; an empty table gives no rows; other columns of
    docs are ignored. The places of a sequence have no gaps.

    Pieces of one length are ranked in cells (hash of id and piece), so that a length that a third
    of all pieces have is ranked by many tasks. The driver sees one count per length; the plan it
    makes has a size that depends on ``capacity`` alone and is joined by length.
    """
    spark = docs.sparkSession
    made = scratch(pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = plan(histogram, capacity)
    cells = max(64, max(histogram.values(), default=0) // RANK_CELL)
    made = made.withColumn("cell", F.pmod(F.xxhash64(F.col("doc_id").cast("string"), "piece", "ids_crc32"), F.lit(cells)))
    counts = made.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "cell").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = made.join(counts, ["length", "cell"]).withColumn("rank", F.col("before") + nth - 1)
    table = spark.createDataFrame(pd.DataFrame(slots, columns=["s_length", "s_rank", "s_count", "s_sequence", "s_offset"]).astype("int64"),
                                  "s_length long, s_rank long, s_count long, s_sequence long, s_offset long")
    placed = ranked.join(F.broadcast(table), (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("s_rank"))
                         & (F.col("rank") < F.col("s_rank") + F.col("s_count")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32",
                         (F.col("s_sequence") + F.col("rank") - F.col("s_rank")).alias("sequence_id"),
                         F.col("s_offset").alias("offset"), *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its token ids (little-endian uint32), from ``pack(..., with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
