"""Alignment of two tokenizers over a corpus, with corpus-wide counts of linked token pairs.

Both tokenizers cut between a solid character and a following blank or line end, and between a letter
and a sign after it. So a text is a sequence of units (a word with its blank, the signs after it, or
whatever stands up to the next blank) whose alignments don't depend on each other. A unit is aligned
once and remembered; a text is put together from its units.

First pass: each task counts the pairs of its texts. The distinct pairs get a minimal perfect hash;
the counts of each task become a dense vector indexed by it, and the vectors are summed up a tree.
Second pass: texts are aligned again and the count of every link is looked up, its key verified.

Linked tokens end at the same byte, so the bytes of one are the last bytes of the other: the two
vocabularies bound the number of distinct pairs (``most_pairs``), whatever the corpus. That is why
hash, keys and counts may go to every worker.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch
from tidemark.llm.perfect_hash import PerfectHash

#: Units that a worker remembers, and the characters they may have.
MEMORY, HELD = 400_000, 1 << 24
#: Characters of units that are looked at together; a longer text is read in parts that end with a unit.
BLOCK = 1 << 21
#: Slots of a row of a dense vector, and rows that one step of the tree adds up.
SLOTS, FAN = 1 << 14, 32
#: Where a text may be cut in any case.
_BREAK = re.compile("(?<=[^\\s\u180e])(?=[ \n])")
#: Letters, and the signs that no token of B joins to a letter before them (A never does).
_LETTER, _SIGNS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_symbols() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the other bytes follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Rows:
    """An array that grows at its end."""

    def __init__(self, dtype: type):
        self.data, self.n = np.zeros(1024, dtype=dtype), 0

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.data):
            self.data = np.concatenate([self.data[:self.n], np.zeros(self.n + 2 * len(more), dtype=self.data.dtype)])
        self.data[self.n:self.n + len(more)] = more
        self.n += len(more)

    @property
    def all(self) -> np.ndarray:
        return self.data[:self.n]


def _sums(size: np.ndarray, ids: list[list[int]]) -> np.ndarray:
    """The bytes of each list of tokens."""
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    upto = np.concatenate([[0], np.cumsum(size[np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))])])
    stop = np.cumsum(n)
    return upto[stop] - upto[stop - n]


class Aligner:
    """Aligns units under tokenizer A (byte-level BPE) and B (a piece model that puts a blank first)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        symbols = byte_symbols()
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if token not in added:
                self.a_bytes[i] = bytes(symbols[c] for c in token)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else
                                b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("\u2581", " ").encode())
        self.width = len(self.b_bytes)
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        names = [f"{i}{end}" for x, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(x))]
        self.names, self.name_size = names, np.array([len(x) for x in names])
        # Units are independent only if no token of either side goes on over the end of one.
        steps = json.loads(self.a.to_str())
        cut = steps["pre_tokenizer"] or {}
        joined = re.compile(b"[^ ][ ]|\n.|.\n", re.S)
        self.by_unit = (not steps["normalizer"] and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
                        and not any(len(t) > 1 and joined.search(t) for t in self.b_bytes))
        pieces = [t.decode("utf-8", "replace") for t in self.b_bytes]
        signs = "".join(re.escape(c) for c in _SIGNS if not any(re.search(_LETTER + re.escape(c), p) for p in pieces if c in p))
        word = f" {_LETTER}+(?=[{signs} \n]|\\Z)|[{signs}]+(?=[ \n]|\\Z)|" if signs else ""
        self.units = re.compile(f"{word}.+?(?=(?<=[^\\s\u180e])[ \n]|\\Z)", re.S).findall
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.strings: list[str] = []
        self.n_a, self.n_b, self.n_links, self.begin = (_Rows(np.int64) for _ in range(4))
        self.valid, self.keys = _Rows(bool), _Rows(np.int64)
        self.held = 0
        #: Another one whenever numbers are given anew.
        self.generation = object()

    def most_pairs(self) -> int:
        """How many pairs can ever be linked: one token's bytes end the other's."""
        def by_bytes(x: list[bytes]) -> dict[bytes, int]:
            out: dict[bytes, int] = {}
            for t in x:
                if t:
                    out[t] = out.get(t, 0) + 1
            return out
        a, b = by_bytes(self.a_bytes), by_bytes(self.b_bytes)
        longer_a = sum(n * b.get(t[k:], 0) for t, n in a.items() for k in range(len(t)))
        return longer_a + sum(n * a.get(t[k:], 0) for t, n in b.items() for k in range(1, len(t)))

    def parts(self, text: str) -> Iterator[list[str]]:
        """The units of a blank and the text, about BLOCK characters at a time."""
        whole, begin = " " + text, 0
        if not self.by_unit:
            yield [whole]
            return
        while len(whole) - begin > BLOCK:
            end = _BREAK.search(whole, begin + BLOCK)
            if not end:
                break
            yield self.units(whole, begin, end.start())
            begin = end.start()
        yield self.units(whole, begin)

    def learn(self, units: list[str]) -> None:
        """Align units not seen before."""
        self.held += sum(map(len, units))
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        # B puts a blank before what isn't empty. Where a unit has none to give, a letter takes it and is dropped again.
        bare = [u[0] == " " < u for u in units]
        b = [ids if given else ids[1:] for given, ids in
             zip(bare, self.b.encode([u[1:] if given else "a" + u for given, u in zip(bare, units)], num_threads=1))]
        valid = np.ones(len(units), dtype=bool)
        for ids, size, names in ((a, self.a_size, self.a_bytes), (b, self.b_size, self.b_bytes)):
            said = list(map(names.__getitem__, chain.from_iterable(ids)))
            if b"".join(said) != b"".join(raw) or (_sums(size, ids) != list(map(len, raw))).any():
                valid &= np.array([b"".join(map(names.__getitem__, x)) == r for x, r in zip(ids, raw)], dtype=bool)
        if not valid.all():
            a, b = ([ids if ok else [] for ids, ok in zip(x, valid.tolist())] for x in (a, b))
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        # Valid units follow each other without gaps, so all offsets are those of one long text.
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, common), np.searchsorted(ends_b, common)
        unit = np.searchsorted(np.cumsum(n_a), last_a, "right")
        n_links = np.bincount(unit, minlength=len(units)).astype(np.int64)
        # Names in the order of the groups, A's tokens before B's; the last of each side ends with | or ;.
        shift = np.array([0, len(self.a_bytes), 2 * len(self.a_bytes), 2 * len(self.a_bytes) + self.width])
        closing_a, closing_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        closing_a[last_a] = closing_b[last_b] = 1
        code = np.concatenate([ids_a + shift[closing_a], ids_b + shift[2 + closing_b]])
        group = np.concatenate([2 * np.searchsorted(common, ends_a), 2 * np.searchsorted(common, ends_b) + 1])
        owner = np.concatenate([np.repeat(np.arange(len(units)), n_a), np.repeat(np.arange(len(units)), n_b)])
        order = np.argsort(group, kind="stable")
        said = "".join(map(self.names.__getitem__, code[order].tolist()))
        cuts = np.concatenate([[0], np.cumsum(np.bincount(owner, self.name_size[code], minlength=len(units)))]).astype(np.int64).tolist()
        self.known.update(zip(units, range(len(self.strings), len(self.strings) + len(units))))
        self.strings += [said[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
        self.begin.add(self.keys.n + np.cumsum(n_links) - n_links)
        self.keys.add(ids_a[last_a] * self.width + ids_b[last_b])
        for rows, more in ((self.n_a, n_a), (self.n_b, n_b), (self.n_links, n_links), (self.valid, valid)):
            rows.add(more)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number under which each unit is known."""
        new = set(units) - self.known.keys()
        if new and (len(self.known) + len(new) > MEMORY or self.held > HELD):
            self.forget()
            new = set(units)
        if new:
            self.learn(list(new))
        return np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process and pair of files."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


@dataclass
class PairCounts:
    """The number of links of every distinct pair, indexed by a minimal perfect hash of the pairs.

    ``keys`` (A's id times ``width`` plus B's id) verify a lookup; ``best`` tells whether a pair has
    the highest count of its B id.
    """

    index: PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray
    width: int

    def lookup(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each pair; -1 for a pair that the corpus never has linked."""
        slots = self.index.slots(keys)
        if not self.index.size:
            return slots
        return np.where((slots >= 0) & (self.keys[slots] == keys), slots, -1)


def _blocks(parts: Iterator[tuple[int, list[str], bool, bool]]) -> Iterator[list[tuple[int, list[str], bool, bool]]]:
    """Parts of texts, about BLOCK characters together."""
    block, size = [], 0
    for part in parts:
        block.append(part)
        size += sum(map(len, part[1]))
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def _parts(known: Aligner, texts: list[str | None]) -> Iterator[tuple[int, list[str], bool, bool]]:
    """(row, units, whether they begin the text, whether they end it) for every text that isn't empty."""
    for row, text in enumerate(texts):
        if text:
            held, first = None, True
            for units in known.parts(text):
                if held is not None:
                    yield row, held, first, False
                    first = False
                held = units
            yield row, held, first, True


def _read(known: Aligner, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, list[str], bool, bool]]]]:
    """Blocks of parts: the numbers of all units, where each part begins among them, and whether it is valid."""
    for block in _blocks(_parts(known, texts)):
        at = known.numbers([u for _, units, _, _ in block for u in units])
        sizes = np.array([len(units) for _, units, _, _ in block])
        begins = np.cumsum(sizes) - sizes
        yield at, begins, np.logical_and.reduceat(known.valid.all[at], begins), block


class _Sum:
    """Counts of keys, merged now and then."""

    def __init__(self):
        self.keys, self.n, self.held = [], [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.held += len(keys)
        if self.held > 1 << 21:
            keys, n = self.merged()
            self.keys, self.n, self.held = [keys], [n], 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        keys, where = np.unique(np.concatenate(self.keys), return_inverse=True)
        n = np.zeros(len(keys), dtype=np.int64)
        np.add.at(n, where, np.concatenate(self.n))
        return keys, n


def _links(known: Aligner, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the links of all units of a list, each distinct unit read once, and how often each occurs."""
    times = np.bincount(at)
    unit = np.flatnonzero(times)
    count = known.n_links.all[unit]
    stop = np.cumsum(count)
    place = np.repeat(known.begin.all[unit] - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)
    return known.keys.all[place], np.repeat(times[unit], count)


def _text(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("t"))


def pair_sums(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """(key, n): how often the texts of a task hold each pair linked; one row per task and pair."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total = aligner(a_path, b_path), _Sum()
        for pdf in batches:
            long, fine = _Sum(), True
            for at, begins, valid, block in _read(known, pdf["t"].tolist()):
                ends = [*begins[1:].tolist(), len(at)]
                whole = np.array([first and last for _, _, first, last in block])
                keep = np.repeat(whole & valid, np.array(ends) - begins)
                total.add(*_links(known, at[keep]))
                for k in np.flatnonzero(~whole).tolist():
                    # A text read in parts counts only if all of them are valid.
                    _, _, first, last = block[k]
                    if first:
                        long, fine = _Sum(), True
                    fine = fine and bool(valid[k])
                    long.add(*_links(known, at[begins[k]:ends[k]]))
                    if last and fine:
                        total.add(*long.merged())
        keys, n = total.merged()
        yield pd.DataFrame({"key": keys, "n": n})
    return _text(docs, text_col).mapInPandas(run, "key long, n long")


def count_pairs(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> PairCounts:
    """The corpus-wide number of links of every pair.

    The driver gets the distinct pairs and one count for each, of which there are at most
    ``Aligner.most_pairs()``: some 324,000 for vocabularies of 50,257 and 32,000 tokens.
    """
    spark = docs.sparkSession
    both = aligner(a_path, b_path)
    sums = scratch(pair_sums(docs, a_path, b_path, text_col), "align-sums")
    distinct = sums.select("key").distinct().toPandas()["key"].to_numpy(dtype=np.int64)
    if len(distinct) > both.most_pairs():
        raise ValueError("more pairs than the vocabularies allow")
    index = PerfectHash(np.sort(distinct))
    keys = np.zeros(index.size, dtype=np.int64)
    keys[index.slots(distinct)] = distinct
    counts = _tree_sum(spark, sums, index)
    highest = np.zeros(both.width, dtype=np.int64)
    np.maximum.at(highest, keys % both.width, counts)
    return PairCounts(index, keys, counts, counts == highest[keys % both.width], both.width)


def _tree_sum(spark: SparkSession, sums: DataFrame, index: PerfectHash) -> np.ndarray:
    """The sum of the dense vectors of all tasks, in rows of SLOTS counts; FAN rows at a time."""
    sent = spark.sparkContext.broadcast(index)

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector = np.zeros(sent.value.size, dtype=np.int64)
        for pdf in batches:
            np.add.at(vector, sent.value.slots(pdf["key"].to_numpy()), pdf["n"].to_numpy())
        starts = range(0, len(vector), SLOTS)
        yield pd.DataFrame({"slot": pd.Series(list(starts), dtype="int64"), "v": [vector[s:s + SLOTS].tobytes() for s in starts]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.sum([np.frombuffer(x, dtype=np.int64) for x in pdf["v"]], axis=0)
        return pd.DataFrame({"slot": pdf["slot"].iloc[:1], "part": pdf["part"].iloc[:1] // FAN, "v": [v.tobytes()]})

    rows = sums.mapInPandas(dense, "slot long, v binary").select("slot", F.spark_partition_id().alias("part"), "v")
    rows = scratch(rows, "align-vectors")
    parts = rows.agg(F.max("part")).first()[0]
    while parts:
        rows = rows.groupBy("slot", F.expr(f"part div {FAN}").alias("up")).applyInPandas(add, "slot long, part int, v binary")
        parts //= FAN
    out = np.zeros(index.size, dtype=np.int64)
    for r in rows.select("slot", "v").collect():
        v = np.frombuffer(r["v"], dtype=np.int64)
        out[r["slot"]:r["slot"] + len(v)] = v
    return out


class _Told:
    """What every known unit adds to a document: links with the highest count, the sum of counts, links never counted."""

    def __init__(self, known: Aligner, counts: PairCounts):
        self.known, self.counts, self.generation = known, counts, None

    def refresh(self) -> None:
        if self.generation is not self.known.generation:
            self.generation = self.known.generation
            self.best, self.sums, self.foreign = (_Rows(np.int64) for _ in range(3))
        begin = self.known.begin.all[self.best.n:]
        if not len(begin):
            return
        links = self.known.n_links.all[self.best.n:]
        slots = self.counts.lookup(self.known.keys.all[begin[0]:])
        met = np.append(slots, -1) >= 0
        counted = np.append(self.counts.counts, 0)[np.append(slots, -1)]
        highest = np.append(self.counts.best, False)[np.append(slots, -1)]
        for rows, per_link in ((self.best, highest), (self.sums, counted), (self.foreign, ~met)):
            upto = np.concatenate([[0], np.cumsum(per_link[:-1], dtype=np.int64)])
            rows.add(upto[begin - begin[0] + links] - upto[begin - begin[0]])


RESULT = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align(docs: DataFrame, counts: PairCounts, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text is read with a blank before it. Byte offsets at which tokens of A and of B both end cut the
    tokens into groups, ``a1,a2|b1;a3|b2,b3`` in decimal ids; ``groups_sha256`` is the digest of that
    string. A link is a pair of occurrences that end together; ``counts`` tells how many links of the
    corpus hold the same pair. Null and empty texts, and texts that the bytes of either side's tokens
    don't give back, have no tokens: zeros and an empty string. Special tokens' names are plain text.
    Each row is read on its own, so repeated rows and ids get repeated results, null ids included;
    other columns are ignored; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = aligner(a_path, b_path)
        told = _Told(known, sent.value)
        for pdf in batches:
            out = np.zeros((len(pdf), 6), dtype=np.int64)
            fine = np.array([bool(t) for t in pdf["t"]], dtype=bool)
            hashes = [hashlib.sha256() if ok else None for ok in fine]
            for at, begins, valid, block in _read(known, pdf["t"].tolist()):
                told.refresh()
                rows = np.array([row for row, _, _, _ in block])
                fine[rows[~valid]] = False
                for k, per_unit in enumerate((known.n_a, known.n_b, known.n_links, told.best, told.sums, told.foreign)):
                    np.add.at(out[:, k], rows, np.add.reduceat(per_unit.all[at], begins))
                numbers = at.tolist()
                for (row, units, _, last), begin, ok in zip(block, begins.tolist(), valid.tolist()):
                    if ok:
                        said = "".join(map(known.strings.__getitem__, numbers[begin:begin + len(units)]))
                        hashes[row].update((said[:-1] if last else said).encode())
            out[~fine] = 0
            if out[:, 5].any():
                raise KeyError("the counts are those of another corpus")
            yield pd.DataFrame({"id": pdf["id"], "n_a": out[:, 0], "n_b": out[:, 1], "n_groups": out[:, 2], "n_links": out[:, 2],
                                "n_best": out[:, 3], "count_sum": out[:, 4],
                                "groups_sha256": [h.hexdigest() if ok else "" for h, ok in zip(hashes, fine)]})

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t"))
    return slim.mapInPandas(run, f"id string, {RESULT}").withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def pair_table(spark: SparkSession, counts: PairCounts) -> DataFrame:
    """(a, b, n): every linked pair of token ids and its number of links."""
    found = pd.DataFrame({"a": counts.keys // counts.width, "b": counts.keys % counts.width, "n": counts.counts})
    return spark.createDataFrame(found, "a long, b long, n long")
