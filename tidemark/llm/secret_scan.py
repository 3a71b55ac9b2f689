"""Secrets in texts: patterns, and two character Markov models compared by log-likelihood ratio.

Everything here is a DataFrame expression. A text is never moved: each row finds its own spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the base patterns are, in the order of their kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

#: Runs that the models judge: this long, with a letter and a digit.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: Log-likelihood ratio from which a run counts as random.
MARGIN = 12.0
#: Rows whose ordinary words train the second model, about; the first uses every base match.
TRAIN_ROWS = 20_000
_WORD = r"[A-Za-z_]{4,}"
_BLOCK = 256


def _runs(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def spans(both: Column) -> Column:
        # Prefix sums in two levels, so that a text full of matches is not read anew for each.
        steps = F.transform(both, lambda b: F.length(b["0"]) + F.length(b["1"]))
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
                             lambda k: F.aggregate(F.slice(steps, k * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, x: a + x))

        def one(b: Column, i: Column) -> Column:
            k = F.floor(i / _BLOCK).cast("int")
            start = (F.aggregate(F.slice(blocks, F.lit(1), k), F.lit(0), lambda a, x: a + x)
                     + F.aggregate(F.slice(steps, k * _BLOCK + 1, i - k * _BLOCK), F.lit(0), lambda a, x: a + x) + F.length(b["0"]))
            return F.struct(start.cast("long").alias("start"), (start + F.length(b["1"])).cast("long").alias("end"), b["1"].alias("match"))
        return F.transform(both, one)
    both = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("0"), found.alias("1"))
    return F.when(text.rlike(pattern), spans(both)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,match:string>>"))


def _base(text: Column) -> dict[str, Column]:
    assign = F.filter(_runs(text, ASSIGN), lambda r: F.length(F.regexp_extract(r["match"], ASSIGN, 2)) >= 6)
    return {"assign": assign, "access": _runs(text, ACCESS), "hex": _runs(text, HEX)}


def _transitions(tokens: DataFrame) -> dict[str, int]:
    """Two-character counts over a column ``t``; there are at most 67 * 67."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: F.substring("t", i, F.lit(2))))
    rows = tokens.where(F.length("t") > 1).select(pair.alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()
    return {r["p"]: r["n"] for r in rows if all(c in ALPHABET for c in r["p"])}


def fit(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratios of all transitions, random over ordinary, from labelled strings (column ``t``).

    A transition backs off to how often its second character comes at all, and that to a uniform
    share, so a model without samples is uniform. The list
    is indexed by place(first) * size + place(second); place 0 is a character outside the alphabet.
    """
    size = len(ALPHABET) + 1
    ratio = [0.0] * (size * size)
    for sign, counts in ((1, _transitions(random)), (-1, _transitions(ordinary))):
        rows = {a: sum(counts.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
        second = {b: sum(counts.get(a + b, 0) for a in ALPHABET) + 0.1 for b in ALPHABET}
        total = sum(second.values())
        for i, a in enumerate(ALPHABET, 1):
            for j, b in enumerate(ALPHABET, 1):
                back = second[b] / total
                ratio[i * size + j] += sign * math.log((counts.get(a + b, 0) + len(ALPHABET) * back) / (rows[a] + len(ALPHABET)))
    return ratio


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """Labelled strings: the base matches of all rows, and the ordinary words of about ``rows`` rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = _base(F.col("t"))
    match = F.concat(F.transform(base["assign"], lambda r: F.regexp_extract(r["match"], ASSIGN, 2)),
                     F.transform(base["access"], lambda r: r["match"]), F.transform(base["hex"], lambda r: r["match"]))
    random = docs.select(text.alias("t")).where(F.col("t").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).select(F.explode(match).alias("t"))
    share = min(1.0, rows / max(docs.count(), 1))
    part = docs.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    ordinary = part.select(F.explode(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))).alias("t"))
    return random, ordinary


def find_secrets(docs: DataFrame, ratio: list[float], id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base, spans.

    ``base`` and ``spans`` are arrays of (start, kind, end), kind a place in KINDS, sorted by start and
    kind; ends are exclusive and both count code points. ``spans`` adds to the base the runs outside of
    it that the models take for random. Null and empty texts have no spans. Rows are judged one by
    one, so repeated rows and ids get repeated results; other columns are ignored; an empty table
    gives no rows.
    """
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<double>")

    def likelihood(t: Column) -> Column:
        def at(i: Column) -> Column:
            return F.instr(F.lit(ALPHABET), F.substring(t, i, F.lit(1)))
        return F.aggregate(F.sequence(F.lit(1), F.length(t) - 1), F.lit(0.0),
                           lambda s, i: s + F.element_at(table, at(i) * size + at(i + 1) + 1))

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("id", "t", *[c.alias(k) for k, c in _base(F.col("t")).items()])

    def told(kind: int, runs: Column) -> Column:
        return F.transform(runs, lambda r: F.struct(r["start"].alias("start"), F.lit(kind).alias("kind"), r["end"].alias("end")))
    base = F.array_sort(F.concat(*[told(k, F.col(name)) for k, name in enumerate(KINDS[:3])]))
    rows = rows.select("id", "t", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], base.alias("base"))
    mixed = F.filter(_runs(F.col("t"), CANDIDATE), lambda r: r["match"].rlike("[A-Za-z]") & r["match"].rlike("[0-9]"))
    outside = F.filter(mixed, lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    random = F.filter(outside, lambda r: likelihood(r["match"]) >= margin)
    return rows.select("id", "n_assign", "n_access", "n_hex", "base", F.array_sort(F.concat("base", told(3, random))).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
