"""Toxicity of texts whose words may be disguised: noisy-channel restoration, then a linear score.

Disguised tokens (digits and signs for letters, letters spelled apart, drawn-out letters) are
lattices of letters; the likeliest path under a character trigram model is what they say. The
restored text is scored by the five-letter pieces of its words.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w64
from tidemark.llm.common import fold
from tidemark.llm.langid import merge_counts

#: Labelled rows that train the score, at most: those whose ids have the smallest hashes.
TRAIN_ROWS = 20_000
#: Pieces that the score uses, the surest of those found.
FEATURES = 4000
_SIEVE = 1 << 20
#: Likelihood-ratio statistic from which a piece marks toxic texts, and texts that must have it.
SURE = 20.0
LEAST = 4
PIECE = 5
THRESHOLD = 0.7

# Letters that digits and signs stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e"}
#: Log-probabilities of the channel: sign for letter, letter drawn out, letter masked, sign kept,
#: words joined by a sign.
_SWAP, _DRAWN, _MASK, _KEPT, _APART_COST = -1.0, -0.5, -2.5, -6.0, -1.0
_SIZE = 27
_BLOCK = 1 << 20

_TRIGGER = re.compile(r"[^\W\d_](?:[0-9@$!|+€]|[*._-][^\W\d_])|[0-9@$!|+€][^\W\d_]|([^\W\d_])\1\1")
#: At least four single characters, each apart from the next by the same sign.
_APART = re.compile(r"(?<![\w@$!])[\w@$!]([ .*_-])(?:[\w@$!]\1){2,}[\w@$!](?![\w@$!])")
_BLANK = re.compile(r"\s")
_EDGE = "\"'()[]{}<>.,;:?*#%&^~`"


def _letter_table() -> np.ndarray:
    """Code point -> 1..26 by base letter, 0 for all else."""
    table = np.zeros(0x250, dtype=np.uint8)
    for c in range(0x250):
        base = unicodedata.normalize("NFD", chr(c).lower())[:1]
        if "a" <= base <= "z":
            table[c] = ord(base) - 96
    return table


_LETTERS = _letter_table()


def _classes(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(c < 0x250, _LETTERS[np.minimum(c, 0x24F)], 0)


def trigram_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log P(c | a b) over letter classes, from every text of ``docs``; 27 * 27 * 27 numbers.

    Each task adds up its own counts. Without any text the model is uniform.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in w64.blocks(texts, _BLOCK):
                c = _classes("  ".join(["", *texts[part], ""])).astype(np.int32)
                total += np.bincount(c[:-2] * _SIZE**2 + c[1:-1] * _SIZE + c[2:], minlength=_SIZE**3)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    counts = np.zeros(_SIZE**3)
    for r in rows.mapInPandas(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    three = counts.reshape(_SIZE, _SIZE, _SIZE)
    two = three.sum(axis=0)
    # The pair model fills in where a context is rare.
    back = (two + 0.5) / (two + 0.5).sum(axis=1, keepdims=True)
    return np.log((three + 20 * back) / (three.sum(axis=2, keepdims=True) + 20))


def _lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters, what it may stand for, with the channel's log-probability."""
    out = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        c, n = m[1], len(m[0])
        if c.isalpha():
            keep = [(c * n, 0.0)] if n < 3 else [(c, _DRAWN), (c * 2, _DRAWN)]
            out.append(keep)
        elif c in LEET:
            swaps = [(x * k, _SWAP * k) for x in LEET[c] for k in ((1,) if n == 1 else (1, 2))]
            out.append([*swaps, ("", _MASK), (m[0], _KEPT)])
        elif c.isdigit():
            out.append([(m[0], _KEPT)])
        else:
            out.append([("", _MASK), (m[0], _APART_COST)])
    return out


def decode(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a lower-case token: Viterbi over its lattice under the trigram model."""
    best: dict[tuple[int, int], tuple[float, list | None]] = {(0, 0): (0.0, None)}
    for options in _lattice(token):
        after: dict[tuple[int, int], tuple[float, list | None]] = {}
        for (a, b), (score, path) in best.items():
            for text, cost in options:
                x, y, s = a, b, score + cost
                for k in _classes(text).tolist() if text else ():
                    s += model[x, y, k]
                    x, y = y, k
                if (x, y) not in after or s > after[x, y][0]:
                    after[x, y] = s, [path, text]
        best = after
    end = max(best.items(), key=lambda e: e[1][0] + model[e[0][0], e[0][1], 0])[1][1]
    parts = []
    while end is not None:
        parts.append(end[1])
        end = end[0]
    return "".join(reversed(parts))


class Restorer:
    """Restores texts; remembers a bounded number of tokens."""

    MEMORY = 100_000

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def _word(self, token: str) -> str:
        core = token.strip(_EDGE)
        bare = core.rstrip("!$|+@")
        core = bare if bare.isalpha() else core
        if not core or not _TRIGGER.search(core):
            return token
        if core not in self.known:
            if len(self.known) >= self.MEMORY:
                self.known = {}
            self.known[core] = decode(core, self.model)
        at = token.index(core)
        return token[:at] + self.known[core] + token[at + len(core):]

    def restore(self, text: str) -> str:
        """Lower case, with disguised words in plain letters."""
        text = text.lower()
        text = _APART.sub(lambda m: m[0].replace(m[1], ""), text)
        parts, done = [], 0
        for m in _TRIGGER.finditer(text):
            if m.start() < done:
                continue
            begin = max(done, *(text.rfind(c, done, m.start()) + 1 for c in " \n\t\r\xa0"))
            end = _BLANK.search(text, m.end())
            end = end.start() if end else len(text)
            parts += text[done:begin], self._word(text[begin:end])
            done = end
        return "".join([*parts, text[done:]]) if parts else text


def pieces(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the five-letter pieces of the words of each text (words padded by a blank), and where each begins."""
    joined = [t.encode("utf-32-le", "surrogatepass") for t in texts]
    gap = "  ".encode("utf-32-le")
    c = np.frombuffer(gap + gap.join(joined) + gap + gap, dtype=np.uint32)
    letter = c < 0x250
    c = np.where(letter, c, 0x2D0 + (c & 0xFF)).astype(np.uint64)  # other scripts share 256 symbols
    plain = np.zeros(0x400, dtype=bool)
    plain[0x2D0:0x3D0] = True
    for i in range(0x250):
        plain[i] = chr(i).isalnum()
    inside = plain[c]
    c = np.where(inside, c, np.uint64(32))
    h = np.zeros(len(c) - PIECE + 1, dtype=np.uint64)
    for k in range(PIECE):
        h = h * np.uint64(0x9E3779B97F4A7C15) + c[k:len(c) - PIECE + 1 + k] + np.uint64(1)
    # Only the ends of a piece may be blanks.
    ok = inside[1:len(c) - 3] & inside[2:len(c) - 2] & inside[3:len(c) - 1]
    slots = (w64.mix(h) >> np.uint64(1)).astype(np.int64)
    ends = np.cumsum([len(t) // 4 + 2 for t in joined])
    at = np.flatnonzero(ok)
    return slots[at], np.concatenate([[0], np.searchsorted(at, ends)])


class Score(NamedTuple):
    """Sorted hashes of the pieces that count, their weights, and the bias."""
    known: np.ndarray
    weights: np.ndarray
    bias: float

    def of(self, texts: list[str]) -> np.ndarray:
        slots, offsets = pieces(texts)
        sieve = np.zeros(_SIEVE, dtype=bool)
        sieve[self.known & (_SIEVE - 1)] = True
        held = np.flatnonzero(sieve[slots & (_SIEVE - 1)])
        at = np.searchsorted(self.known, slots[held])
        true = self.known[np.minimum(at, len(self.known) - 1)] == slots[held] if len(self.known) else np.zeros(0, dtype=bool)
        held, at = held[true], at[true]
        each = np.unique((np.searchsorted(offsets, held, "right") - 1) * (len(self.known) + 1) + at)
        total = np.bincount(each // (len(self.known) + 1), self.weights[each % (len(self.known) + 1)], minlength=len(texts))
        return 1.0 / (1.0 + np.exp(-np.clip(total + self.bias, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", rows: int = TRAIN_ROWS) -> Score:
    """A logistic score from at most ``rows`` labelled rows outside fold 1.

    One pass counts in how many toxic texts each piece occurs, one more in how many others those
    that at least LEAST have do; the FEATURES pieces that mark toxic texts most surely are kept. The
    last pass gives the rows as lists of kept pieces, on which the driver fits the weights. Rows
    without label or text train nothing; with only one class the score is its share.
    """
    spark = docs.sparkSession
    pick = (labels.where((fold(F.col(id_col)) != 1) & F.col(label_col).isNotNull())
            .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y"))
            .groupBy("_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("_id"), "_id").limit(rows))
    # Bounded by ``rows``.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("text is not null").join(F.broadcast(pick), "_id")
    sample = sample.select("text", "y")
    restorer = spark.sparkContext.broadcast(Restorer(model))

    def sets(texts: list[str]) -> list[np.ndarray]:
        slots, offsets = pieces([restorer.value.restore(t) for t in texts])
        return [np.unique(slots[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:])]

    def toxic(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
        n = np.zeros(2, dtype=np.int64)
        for pdf in batches:
            bad = pdf["y"].to_numpy() > 0
            n += [(~bad).sum(), bad.sum()]
            texts = pdf["text"][bad].tolist()
            for part in w64.blocks(texts, _BLOCK):
                found = [merge_counts([*found, np.unique(np.concatenate(sets(texts[part])), return_counts=True)])]
        yield pd.DataFrame({"slot": [-1], "n0": n[:1], "n1": n[1:]})
        yield pd.DataFrame({"slot": found[0][0], "n0": 0, "n1": found[0][1]})
    counts = sample.mapInPandas(toxic, "slot long, n0 long, n1 long").groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = counts.where((F.col("slot") == -1) | (F.col("n1") >= LEAST)).toPandas().sort_values("slot")
    whole = seen[seen["slot"] == -1]
    all0, all1 = (int(whole["n0"].sum()), int(whole["n1"].sum()))
    if not all0 or not all1:
        share = (all1 + 0.5) / (all0 + all1 + 1)
        return Score(np.zeros(0, dtype=np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    seen = seen[seen["slot"] != -1]
    likely, n1 = seen["slot"].to_numpy(), seen["n1"].to_numpy()
    shared = spark.sparkContext.broadcast(likely)

    def other(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n0 = np.zeros(len(shared.value), dtype=np.int64)
        for pdf in batches:
            texts = pdf["text"][pdf["y"].to_numpy() <= 0].tolist()
            for part in w64.blocks(texts, _BLOCK):
                for s in sets(texts[part]):
                    n0[np.isin(shared.value, s, assume_unique=True)] += 1
        at = np.flatnonzero(n0)
        yield pd.DataFrame({"at": at, "n0": n0[at]})
    n0 = np.zeros(len(likely), dtype=np.int64)
    for r in sample.mapInPandas(other, "at long, n0 long").groupBy("at").agg(F.sum("n0").alias("n0")).collect():
        n0[r["at"]] = r["n0"]
    share, n = all1 / (all0 + all1), n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        sure = 2 * (n1 * np.log(n1 / (n * share)) + np.where(n0 > 0, n0 * np.log(n0 / (n * (1 - share))), 0))
    marks = np.flatnonzero((n1 > 4 * share * n) & (sure >= SURE))
    known = np.sort(likely[marks[np.argsort(-sure[marks], kind="stable")[:FEATURES]]])

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in w64.blocks(texts, _BLOCK):
                held = [np.flatnonzero(np.isin(known, s, assume_unique=True)) for s in sets(texts[part])]
                yield pd.DataFrame({"y": pdf["y"].iloc[part].to_numpy(), "x": held})
    table = sample.mapInPandas(rows_of, "y int, x array<long>").toPandas()
    weights, bias = _logistic(table["x"].tolist(), (table["y"] > 0).to_numpy(dtype=float), len(known))
    return Score(known, weights, bias)


def _logistic(rows: list[np.ndarray], y: np.ndarray, width: int, ridge: float = 0.05, steps: int = 500) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient descent on sparse 0/1 rows; weights stay at or above zero."""
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([np.asarray(r, dtype=np.int64) for r in rows]) if rows else np.zeros(0, dtype=np.int64)
    w, bias = np.zeros(width), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    top = np.ones(width)  # towards the largest curvature, which bounds the step
    for _ in range(20):
        top = np.bincount(col, np.bincount(row, top[col], minlength=len(y))[row], minlength=width)
        size = float(np.linalg.norm(top)) or 1.0
        top = top / size
    rate = 1.0 / (0.3 * size + ridge)
    ahead = w.copy()
    for k in range(steps):
        z = np.bincount(row, ahead[col], minlength=len(y)) + bias
        miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        new = np.maximum(ahead - rate * (np.bincount(col, miss[row], minlength=width) + ridge * ahead), 0)
        ahead, w = new + k / (k + 3) * (new - w), new
        bias -= float(miss.mean())
    return w, bias


def score(docs: DataFrame, model: np.ndarray, fitted: Score, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1, higher is likelier toxic), and ``restored`` on demand.

    Null and empty texts get the score of a text without any piece. Rows are scored one by one:
    repeated rows and ids get repeated results; other columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((Restorer(model), fitted))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, known = held.value
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in w64.blocks([t or "" for t in texts], _BLOCK):
                plain = [restorer.restore(t or "") for t in texts[part]]
                out = pd.DataFrame({"id": pdf["id"].iloc[part].to_numpy(), "score": known.of(plain)})
                yield out.assign(restored=plain) if with_text else out
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    told = rows.mapInPandas(run, "id string, score double" + ", restored string" * with_text)
    return told.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))
