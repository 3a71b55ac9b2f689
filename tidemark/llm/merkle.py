"""A Merkle manifest of a corpus, and the proofs of all its rows by shared multiproofs.

Every source is a tree over its rows by id; the tree over the sources' subroots gives the root. Rows get
their places by one range shuffle of digests (texts are read once and never moved), and trees grow
GROUP nodes at a time, which is STEP levels.

Proofs: the rows of a leaf partition (GROUP consecutive leaves) share nearly all of what they need.
The partition works out the smallest set of node coordinates that its leaves and what follows from
them do not give, all of these are fetched by one join, and the proofs of single rows are put
together from leaves, derived interiors and fetched nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, scratch

ARITY = 16
STEP = 3
GROUP = ARITY ** STEP
#: The tree whose leaves are the subroots of all sources.
TOP = -1
_NODES = "tree long, size long, level int, pos long, digest string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(fields: Sequence[Column]) -> Column:
    """Digest of the fields in order, each as its length in bytes, a colon and itself, or ``-`` if null."""
    def said(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*map(said, fields)), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def width(size: int, level: int) -> int:
    """The number of nodes on a level of a tree with ``size`` leaves."""
    return -(-size // ARITY ** level)


def missing(known: np.ndarray, size: int, level: int = 0) -> list[tuple[int, int]]:
    """The fewest (level, pos) that, with the ``known`` nodes of a level, give all proofs of these up to the top."""
    out, known = [], np.unique(known)
    while (count := width(size, level)) > 1:
        runs = np.unique(known // ARITY)
        needed = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out += [(level, int(p)) for p in np.setdiff1d(needed[needed < count], known, assume_unique=True)]
        known, level = runs, level + 1
    return out


def grow(nodes: Sequence[str], size: int, level: int, steps: int = STEP) -> list[list[str]]:
    """The levels above consecutive nodes that begin a run and end with one, or with their level."""
    levels = [list(nodes)]
    for up in range(level, level + steps):
        if width(size, up) == 1:
            break
        last = levels[-1]
        levels.append([digest(last[i:i + ARITY]) for i in range(0, len(last), ARITY)])
    return levels


def _climb(rows: DataFrame, level: int, least: int) -> DataFrame:
    """Nodes above the nodes (tree, size, pos, digest) of one level, for STEP levels from ``least`` on, and tops of trees."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        tree, size, first = int(pdf["tree"].iloc[0]), int(pdf["size"].iloc[0]), int(pdf["pos"].iloc[0])
        out = []
        for up, nodes in enumerate(grow(pdf["digest"].tolist(), size, level)):
            if (up and level + up >= least) or (width(size, level + up) == 1 and (up or not level)):
                out += [(tree, size, level + up, first // ARITY ** up + i, d) for i, d in enumerate(nodes)]
        return pd.DataFrame(out, columns=["tree", "size", "level", "pos", "digest"])
    slim = rows.select("tree", "size", "pos", "digest", F.expr(f"pos div {GROUP}").alias("part"))
    return slim.groupBy("tree", "part").applyInPandas(run, _NODES)


def _trees(leaves: DataFrame, largest: int, least: int) -> DataFrame:
    """All nodes from level ``least`` on, and the top of every tree, of leaves (tree, size, pos, digest)."""
    made = [scratch(_climb(leaves, 0, least), "merkle-nodes")]
    level = STEP
    while width(largest, level) > 1:
        below = made[-1].where((F.col("level") == level) & (F.col("size") > ARITY ** level))
        made.append(scratch(_climb(below, level, least), "merkle-nodes"))
        level += STEP
    out = made[0]
    for more in made[1:]:
        out = out.unionByName(more)
    return out


def _tops(nodes: DataFrame) -> DataFrame:
    return nodes.where(f"pow({ARITY}, level) >= size AND (level = 0 OR pow({ARITY}, level - 1) < size)")


def place(rows: DataFrame) -> DataFrame:
    """Rows (id, source, leaf, ...) with tree, size and pos: which source by order, its rows, the row's place in it.

    Rows stand by source (null first), id (null first) and leaf. The range shuffle deals them evenly
    whatever a source holds, rows that are equal in everything included; places follow from counts
    per (range, source).
    """
    rows = scratch(rows.withColumn("tie", F.monotonically_increasing_id()), "merkle-rows")
    order = ["source", "id", "leaf", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = scratch(dealt.drop("tie").withColumn("range", F.shiftright("at", 33)), "merkle-ranges")
    stats = dealt.groupBy("range", "source").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    by_source = Window.partitionBy("source")
    stats = stats.withColumns({
        "before": F.sum("n").over(by_source.orderBy("range")) - F.col("n"), "size": F.sum("n").over(by_source)})
    # A source is counted in the range that it begins in; ranges are few, as many as the shuffle has.
    stats = scratch(stats.withColumn("begins", (F.col("before") == 0).cast("long")), "merkle-stats")
    ranges = stats.groupBy("range").agg(F.sum("begins").alias("m"))
    ranges = ranges.select("range", (F.sum("m").over(Window.orderBy("range")) - F.col("m")).alias("earlier"))
    stats = stats.join(ranges, "range").withColumn(
        "tree", F.col("earlier") + F.sum("begins").over(Window.partitionBy("range").orderBy("source")) - 1)
    stats = stats.select(F.col("range").alias("_range"), F.col("source").alias("_source"), "first", "before", "size", "tree")
    placed = dealt.join(stats, (F.col("range") == F.col("_range")) & F.col("source").eqNullSafe(F.col("_source")))
    return placed.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("range", "at", "_range", "_source", "first", "before")


@dataclass
class Manifest:
    """``leaves`` (tree, size, pos, id, source, leaf, changed), ``nodes`` (tree, size, level, pos, digest) from level
    STEP on and of the whole tree of sources, and the root (null without rows)."""

    leaves: DataFrame
    nodes: DataFrame
    sources: int
    root: str | None


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
          changed: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``changed`` may give the digest of a row as it was found later, null if not looked at."""
    leaf = row_digest([F.col(c) for c in fields])
    other = F.lit(None).cast("string") if changed is None else changed
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.unhex(leaf).alias("leaf"), F.unhex(other).alias("changed"))
    leaves = scratch(place(rows), "merkle-leaves")
    trees = leaves.where("pos = 0").select("tree", "size")
    sources, largest = trees.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    own = _trees(leaves.select("tree", "size", "pos", F.lower(F.hex("leaf")).alias("digest")), largest, STEP)
    subroots = _tops(own).select(F.lit(TOP).cast("long").alias("tree"), F.lit(sources).cast("long").alias("size"), F.col("tree").alias("pos"), "digest")
    subroots = scratch(subroots, "merkle-subroots")
    top = _trees(subroots, sources, 1)
    root = _tops(top).select("digest").first()
    # A lone source's subroot is the root as well; it is named once.
    base = subroots.select("tree", "size", F.lit(0).alias("level"), "pos", "digest").where("size > 1")
    return Manifest(leaves, own.unionByName(base).unionByName(top), sources, root[0] if root else None)


def _wanted(manifest: Manifest) -> DataFrame:
    """(tree, part, of, level, pos): the nodes that each leaf partition lacks."""
    sources = manifest.sources

    def run(batches):
        for pdf in batches:
            rows = []
            for tree, part, size in zip(pdf["tree"].tolist(), pdf["part"].tolist(), pdf["size"].tolist()):
                own = np.arange(part * GROUP, min(size, (part + 1) * GROUP))
                rows += [(tree, part, tree, level, pos) for level, pos in missing(own, size)]
                rows += [(tree, part, TOP, level, pos) for level, pos in missing(np.array([tree]), sources)]
            yield pd.DataFrame(rows, columns=["tree", "part", "of", "level", "pos"])
    parts = manifest.leaves.where(f"pos % {GROUP} = 0").select("tree", F.expr(f"pos div {GROUP}").alias("part"), "size")
    return parts.mapInPandas(run, "tree long, part long, of long, level int, pos long")


def _above(node: str, pos: int, size: int, level: int, of: int, fetched: dict[tuple[int, int, int], str]) -> tuple[list[tuple[str, str]], str]:
    """What stands left and right of a node's ancestors, level by level, and the top that follows."""
    sides = []
    while (count := width(size, level)) > 1:
        begin = pos // ARITY * ARITY
        left = "".join(fetched[of, level, p] for p in range(begin, pos))
        right = "".join(fetched[of, level, p] for p in range(pos + 1, min(begin + ARITY, count)))
        sides.append((left, right))
        node, pos, level = digest([left, node, right]), pos // ARITY, level + 1
    return sides, node


def fold(node: str, sides: Sequence[tuple[str, str]]) -> str:
    """The root that follows from a node and what stands on both sides of it and its ancestors."""
    for left, right in sides:
        node = digest([left, node, right])
    return node


RESULT = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(manifest: Manifest) -> DataFrame:
    """One row per leaf: id (as text), leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the digest of all siblings on the way to the root, ``folded_root`` follows from
    the siblings and the changed leaf, or the leaf itself where none is given.
    """
    sources, root = manifest.sources, manifest.root

    def expand(mine: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("pos")
        tree, size, first = int(mine["tree"].iloc[0]), int(mine["size"].iloc[0]), int(mine["pos"].iloc[0])
        nodes = {(o, lv, p): d for o, lv, p, d in zip(fetched["of"], fetched["level"], fetched["pos"], fetched["digest"])}
        levels = grow([x.hex() for x in mine["leaf"]], size, 0)
        high = len(levels) - 1
        own, subroot = _above(levels[-1][0], first // ARITY ** high, size, high, tree, nodes)
        over, derived = _above(subroot, tree, sources, 0, TOP, nodes)
        outer = own + over
        tail = "".join(left + right for left, right in outer)

        def siblings(level: int, i: int) -> tuple[str, str]:
            begin = i // ARITY * ARITY
            return "".join(levels[level][begin:i]), "".join(levels[level][i + 1:begin + ARITY])
        # What follows a node's own siblings in the proofs of its leaves, from the top of the partition down.
        after = [tail] * len(levels[-1])
        for level in range(high - 1, 0, -1):
            after = ["".join(siblings(level, i)) + after[i // ARITY] for i in range(len(levels[level]))]
        proofs, folded = [], []
        for i, changed in enumerate(mine["changed"]):
            if high:
                left, right = siblings(0, i)
                proofs.append(digest([left, right, after[i // ARITY]]))
            else:
                proofs.append(digest([tail]))
            if changed is None:
                folded.append(derived)
            else:
                sides = [siblings(level, i // ARITY ** level) for level in range(high)]
                folded.append(fold(changed.hex(), sides + outer))
        return pd.DataFrame({"id": mine["id"], "leaf": levels[0], "subroot": subroot, "root": root, "proof_sha256": proofs,
                             "folded_root": folded, "verified": [f == root for f in folded]})

    wanted, nodes = _wanted(manifest), manifest.nodes.select(F.col("tree").alias("of"), "level", "pos", "digest")
    fetched = wanted.join(nodes, ["of", "level", "pos"]).select("tree", "part", "of", "level", "pos", "digest")
    leaves = manifest.leaves.select("tree", F.expr(f"pos div {GROUP}").alias("part"), "size", "pos", F.col("id").cast("string").alias("id"), "leaf", "changed")
    return leaves.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInPandas(expand, f"id string, {RESULT}")


def tampered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: Sequence[str] = FIELDS, every: int = 5) -> Column:
    """The digest of a row whose text has lost its capital letters, where ``every`` divides the CRC of its id."""
    changed = [lower_ascii(F.col(c)) if c == text_col else F.col(c) for c in fields]
    return F.when(F.crc32(F.col(id_col).cast("string")) % every == 0, row_digest(changed))


def proofs(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", fields: Sequence[str] = FIELDS, changed: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows of a source stand by id, null ids first, rows with equal ids by their digests; equal rows are
    leaves of their own. Nulls of any field, empty and long texts are hashed as they are; a null
    source is a source like any other and comes first. Columns beyond ``fields`` don't count; an
    empty table gives no rows.
    """
    told = prove(build(docs, fields, id_col, source_col, changed))
    return told.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType))


def oracle_sql(levels: int = 4) -> str:
    """The same for DuckDB, for sources (and numbers of sources) of at most ARITY ** levels."""
    def said(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    byte = f"list_reduce(list_concat([xor(a, c)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, _: {step})"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, c: {byte}), 4294967295)"
    ctes = [f"""t AS (SELECT doc_id, {said('text')} AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN {said("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {said('text')} END AS found,
  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, source FROM documents)""",
            "o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos FROM t)",
            "own0 AS (SELECT tree, pos AS p, leaf AS d, count(*) OVER (PARTITION BY tree) AS c FROM o)"]

    def climb(name: str) -> None:
        for k in range(levels):
            ctes.append(f"""{name}{k + 1} AS (SELECT tree, p // 16 AS p, CASE WHEN any_value(c) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY p)) END AS d,
  (any_value(c) + 15) // 16 AS c FROM {name}{k} GROUP BY tree, p // 16)""")
            around = [f"coalesce(string_agg(d, '') OVER (PARTITION BY tree, p // 16 ORDER BY p ROWS BETWEEN {x}), '')"
                      for x in ("UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING")]
            ctes.append(f"{name}_side{k} AS (SELECT tree, p, c, {around[0]} AS l, {around[1]} AS r FROM {name}{k})")
    climb("own")
    ctes.append(f"all0 AS (SELECT 0 AS tree, tree AS p, d, count(*) OVER () AS c FROM own{levels})")
    climb("all")
    proof, joins = [], []
    above = f"SELECT o.*, own{levels}.d AS subroot, all{levels}.d AS root, found AS x0"
    for n, (name, k) in enumerate([(name, k) for name in ("own", "all") for k in range(levels)]):
        key = f"{name}_side{k}.tree = o.tree AND {name}_side{k}.p = o.pos // {16 ** k}" if name == "own" else f"{name}_side{k}.p = o.tree // {16 ** k}"
        joins.append(f"JOIN {name}_side{k} ON {key}")
        proof.append(f"{name}_side{k}.l || {name}_side{k}.r")
        above += f", {name}_side{k}.c AS c{n}, {name}_side{k}.l AS l{n}, {name}_side{k}.r AS r{n}"
    ctes.append(f"f0 AS ({above}, sha256({' || '.join(proof)}) AS proof_sha256 FROM o JOIN own{levels} USING (tree) CROSS JOIN all{levels} {' '.join(joins)})")
    for n in range(2 * levels):
        ctes.append(f"f{n + 1} AS (SELECT * EXCLUDE (x0), CASE WHEN c{n} = 1 THEN x0 ELSE sha256(l{n} || x0 || r{n}) END AS x0 FROM f{n})")
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, root, proof_sha256, x0 AS folded_root, x0 = root AS verified FROM f{2 * levels}""")
