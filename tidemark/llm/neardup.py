"""Near duplicates by a chosen-path set similarity join over minwise tokens.

Documents with equal shingle sets are one class from the start. Each class gets 128 minwise values of
its set. A tree sends a class down the branches named by the values at a few chosen coordinates;
TREES independent trees of BRANCH coordinates per node make the first level. A node whose undecided
pairs are few for its size is compared exhaustively; larger ones branch again. A pair with
similarity s survives a level with probability at least 1 - (1 - s q)^2, so with s = 0.8 a tree of
any depth keeps it with q = 0.9375, and six trees lose it with probability 6e-8.

Groups: one member of every first node, its pivot, is compared with all others there, on full sets,
and then the one that was most like it. Linked members share a label, and later only pairs of different labels count as undecided
- the links that matter are those between components. A group of near copies that holds a third of
all rows thus costs a few comparisons per member, not all pairs, and nothing is capped: what stays
undecided keeps branching, and is compared at the last level whatever its size.

Undecided pairs of a node become rows only while they are few for its members. The members of other
nodes are compared block against block inside a task, first by sketches; what these leave open is a
tile of at most SIDE x SIDE pairs, which travels as one row with the texts of its members and comes
back as the links that connect them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as w64
from tidemark.llm.common import discard, keep_rows, scratch, text_key
from tidemark.llm.components import connected_components

VALUES = 128
TREES = 6
BRANCH = 2
#: A node is compared when it has at most this many undecided pairs per member; doubles per level.
SMALL = 256
DEPTH = 12
#: Up to this many undecided pairs per member are joined as rows, more are compared in blocks.
FEW = 16
#: Members of a block, and of one side of a tile.
SIDE_ROWS, SIDE = 8192, 1024
#: Of 128 two-bit sketches, pairs at the threshold differ in 19 on average; more than 42 has odds below 1e-6.
DIFFER = 42
_BLOCK = 1 << 20
_MUL = np.random.default_rng(7).integers(0, 2**64, VALUES, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; all words as one if there are fewer."""
    hashes, offsets = w64.word_hashes(texts, w64.SOLID)
    rolled = hashes.copy()
    for k in range(1, size):
        rolled[:-k] = rolled[:-k] * np.uint64(0xD6E8FEB86659FD93) + hashes[k:]
    rolled = w64.mix(rolled)
    sets = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        n = hi - lo
        if n >= size:
            sets.append(np.unique(rolled[lo:hi - size + 1]))
        elif n:
            few = np.uint64(n)
            for h in hashes[lo:hi]:
                few = few * np.uint64(0xD6E8FEB86659FD93) + h
            sets.append(w64.mix(np.array([few], dtype=np.uint64)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def _minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the mixed values for each multiplier, 32 bits of it."""
    low = np.full(VALUES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048, None] * _MUL
        low = np.minimum(low, ((part ^ (part >> np.uint64(29))) >> np.uint64(16)).astype(np.uint32).min(axis=0))
    return low


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """id, key, n (set size), h1 and h2 (identity of the set), s (two bits a value), values."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["t"].tolist()
            for part in w64.blocks(texts, _BLOCK):
                with np.errstate(over="ignore"):
                    sets = shingle_sets(texts[part], size)
                    values = np.array([_minwise(s) for s in sets]).reshape(len(sets), VALUES)
                    ones = [w64.mix(s * np.uint64(0x9FB21C651E98DF25) + np.uint64(1)).sum(dtype=np.uint64) for s in sets]
                    twos = [w64.mix(s * np.uint64(0xA24BAED4963EE407) + np.uint64(2)).sum(dtype=np.uint64) for s in sets]
                low, high = (np.packbits((values >> np.uint32(k) & 1).astype(np.uint8), axis=1).view(">u8").astype(np.uint64).view(np.int64) for k in (0, 1))
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[part].to_numpy(), "key": pdf["key"].iloc[part].to_numpy(), "n": [len(s) for s in sets],
                    "h1": np.array(ones, dtype=np.uint64).view(np.int64), "h2": np.array(twos, dtype=np.uint64).view(np.int64),
                    "l1": low[:, 0], "l2": low[:, 1], "h3": high[:, 0], "h4": high[:, 1],
                    "values": list(values.view(np.int32))})
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_key(F.col(text_col)).alias("key"),
                       F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "utf-8").alias("t"))
    made = rows.mapInPandas(run, "id string, key binary, n long, h1 long, h2 long, l1 long, l2 long, h3 long, h4 long, values array<int>")
    bits = F.struct("l1", "l2", "h3", "h4").alias("s")
    return made.select(F.col("id").cast("long").alias("id"), "key", "n", "h1", "h2", bits, "values")


def _alike(a: str, b: str, percent: int) -> Column:
    """Sizes that allow the similarity, and sketches that do not rule it out."""
    fits = (F.least(f"{a}.n", f"{b}.n") * 100 >= F.greatest(f"{a}.n", f"{b}.n") * percent)
    differ = F.expr(f"bit_count(({a}.s.l1 ^ {b}.s.l1) | ({a}.s.h3 ^ {b}.s.h3)) + bit_count(({a}.s.l2 ^ {b}.s.l2) | ({a}.s.h4 ^ {b}.s.h4))")
    return fits & (differ <= DIFFER)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, t): one text of each class that ``nodes`` names, written to the shared folder."""
    wanted = classes.join(nodes.distinct(), "node", "left_semi").select("node", F.col("rep.id").alias("_id"), F.col("rep.key").alias("_key"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("t"))
    found = rows.join(wanted, rows["id"].eqNullSafe(wanted["_id"]) & (rows["key"] == wanted["_key"]))
    # Rows that repeat id and text are one class.
    return scratch(found.groupBy("node").agg(F.min("t").alias("t")), "neardup-texts")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b"))


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, similarity) of the pairs that are linked, compared on full sets; pairs without texts are left out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                some = pdf.iloc[lo:lo + 512]
                text = dict(zip(some["a"], some["ta"])) | dict(zip(some["b"], some["tb"]))
                known: dict[int, np.ndarray] = {}
                names, bodies = list(text), list(text.values())
                with np.errstate(over="ignore"):
                    for part in w64.blocks(bodies, _BLOCK):
                        known.update(zip(names[part], shingle_sets(bodies[part], size)))
                rows = []
                for a, b in zip(some["a"], some["b"]):
                    both = len(np.intersect1d(known[a], known[b], assume_unique=True))
                    either = len(known[a]) + len(known[b]) - both
                    if 100 * both >= percent * either:
                        rows.append((a, b, both / either))
                yield pd.DataFrame(rows, columns=["a", "b", "similarity"])
    raw = texts.select("node", F.encode("t", "utf-8").alias("t"))
    left = pairs.join(raw.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    full = left.join(raw.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return full.select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long, similarity double")


def _tiles(rows: DataFrame, first: bool, percent: int) -> DataFrame:
    """Undecided pairs of large nodes, one row per tile: members xs and ys, and the pairs as places (two bytes each) in both.

    Members that don't have the node's largest label meet all members; both sides are dealt into
    blocks of about SIDE_ROWS, so that a task holds two blocks whatever the node's size.
    """
    def block(salt: int, n: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["path", "node", "n", "label", "major", "mask", "roots",
               *[F.col(f"s.{c}").alias(c) for c in ("l1", "l2", "h3", "h4")], (F.col("root") if first else F.lit(VALUES)).alias("root")]
    dealt = rows.withColumns({f"{side}n": F.ceil(F.col(n) / SIDE_ROWS).cast("int") for side, n in (("x", "others"), ("y", "members"))})
    x = dealt.where("label <> major").withColumn("bx", block(1, "xn")).withColumn("by", every("yn"))
    y = dealt.withColumn("by", block(2, "yn")).withColumn("bx", every("xn"))
    both = x.select(F.lit(True).alias("is_x"), "bx", "by", *columns).unionByName(y.select(F.lit(False).alias("is_x"), "bx", "by", *columns))

    def open_pairs(x: pd.DataFrame, y: pd.DataFrame) -> np.ndarray:
        def grid(name: str) -> tuple[np.ndarray, np.ndarray]:
            return x[name].to_numpy()[:, None], y[name].to_numpy()[None, :]
        label, node, n = grid("label"), grid("node"), grid("n")
        out = (label[0] != label[1]) & ((label[1] == y["major"].to_numpy()[None, :]) | (node[0] < node[1]))
        out &= np.minimum(*n) * 100 >= np.maximum(*n) * percent
        # Counted as unsigned: of a negative number the bits of its absolute value would be counted.
        bits = [(a ^ b).view(np.uint64) for a, b in map(grid, ("l1", "l2", "h3", "h4"))]
        out &= np.bitwise_count(bits[0] | bits[2]).astype(np.int16) + np.bitwise_count(bits[1] | bits[3]) <= DIFFER
        if out.any():
            # Not in a compared first node before this one.
            mine, other = (np.stack(side["roots"].to_numpy()) for side in (x, y))
            for i in range(min(int(x["root"].iloc[0]), TREES * BRANCH)):
                met = (x["mask"].to_numpy() >> i & 1).astype(bool)
                out &= ~((mine[:, i][:, None] == other[:, i][None, :]) & met[:, None])
        return out

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["is_x"]].sort_values("node"), pdf[~pdf["is_x"]].sort_values("node")
        found = []
        for i in range(0, len(x), SIDE):
            for j in range(0, len(y), SIDE):
                some_x, some_y = x.iloc[i:i + SIDE], y.iloc[j:j + SIDE]
                at_x, at_y = np.nonzero(open_pairs(some_x, some_y))
                if len(at_x):
                    in_x, in_y = np.unique(at_x), np.unique(at_y)
                    found.append((some_x["node"].to_numpy()[in_x], some_y["node"].to_numpy()[in_y],
                                  np.searchsorted(in_x, at_x).astype(np.uint16).tobytes(), np.searchsorted(in_y, at_y).astype(np.uint16).tobytes()))
        return pd.DataFrame(found, columns=["xs", "ys", "i", "j"])
    return both.groupBy("path", "bx", "by").applyInPandas(run, "xs array<long>, ys array<long>, i binary, j binary")


def shared(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of left[i] and right[j]: by matrix products where many pairs are asked for."""
    values, where, times = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    # A product of a column takes some 1e-10 s a cell, a pair on its own some 2.5e-5 s.
    if len(i) * 250_000 < len(left) * len(right) * int((times > 1).sum()):
        return np.array([len(np.intersect1d(left[a], right[b], assume_unique=True)) for a, b in zip(i, j)], dtype=np.int64)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    column = np.cumsum(times > 1) - 1
    often = times[where] > 1
    where, owner = column[where[often]], owner[often]
    order = np.argsort(where, kind="stable")
    where, owner = where[order], owner[order]
    out, cuts = np.zeros((len(left), len(right)), dtype=np.float32), np.searchsorted(where, np.arange(0, len(values) + 2048, 2048))
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            held = np.zeros((len(left) + len(right), 2048), dtype=np.float32)
            held[owner[lo:hi], where[lo:hi] % 2048] = 1
            out += held[:len(left)] @ held[len(left):].T
    return out[i, j].astype(np.int64)


def _tile_links(tiles: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links that connect what the links of each tile connect, compared on full sets."""
    def run(tile: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        names, bodies = members["node"].tolist(), members["t"].tolist()
        sets: dict[int, np.ndarray] = {}
        with np.errstate(over="ignore"):
            for part in w64.blocks(bodies, _BLOCK):
                sets.update(zip(names[part], shingle_sets(bodies[part], size)))
        links = []
        for xs, ys, i, j in zip(tile["xs"], tile["ys"], tile["i"], tile["j"]):
            i, j = np.frombuffer(i, dtype=np.uint16), np.frombuffer(j, dtype=np.uint16)
            left, right = [sets[x] for x in xs], [sets[y] for y in ys]
            both = shared(left, right, i, j)
            either = np.array([len(s) for s in left])[i] + np.array([len(s) for s in right])[j] - both
            yes = 100 * both >= percent * either
            top: dict[int, int] = {}

            def root(x: int) -> int:
                while top.setdefault(x, x) != x:
                    x = top[x]
                return x
            for a, b in zip(np.asarray(xs)[i[yes]].tolist(), np.asarray(ys)[j[yes]].tolist()):
                if (ra := root(a)) != (rb := root(b)):
                    top[max(ra, rb)] = min(ra, rb)
                    links.append((a, b))
        return pd.DataFrame(links, columns=["a", "b"])
    wanted = tiles.select(F.col("tile").alias("of"), F.explode(F.array_distinct(F.concat("xs", "ys"))).alias("node"))
    bodies = wanted.join(texts.select("node", F.encode("t", "utf-8").alias("t")), "node").select("of", "node", "t")
    return tiles.groupBy("tile").cogroup(bodies.groupBy("of")).applyInPandas(run, "a long, b long")


def _children(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of large nodes, one for each chosen coordinate, under the path that its value names."""
    def child(j: int) -> Column:
        at = F.pmod(F.xxhash64("path", F.lit(j)), F.lit(VALUES)).cast("int")
        return F.xxhash64("path", F.lit(j), F.element_at("values", at + 1))
    full = rows.join(classes.select("node", "values"), "node")
    return full.withColumn("path", F.explode(F.array(*[child(j) for j in range(BRANCH)]))).drop("values")


def similarity_links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """Links (a, b), confirmed or by way of confirmed ones, that connect the classes of every component."""
    roots = F.posexplode(F.array(*[F.xxhash64(F.lit(j), F.element_at("values", j + 1)) for j in range(TREES * BRANCH)]))
    rows = classes.select(roots.alias("root", "path"), "node", "n", "s", F.col("node").alias("label"))
    compared, linked = _pivot_pairs(docs, classes, rows.drop("root"), id_col, text_col, size, percent)
    near = connected_components(linked)
    discard(linked)
    rows = rows.join(near.withColumnRenamed("label", "_new"), "node", "left")
    rows = scratch(rows.withColumn("label", F.coalesce("_new", "label")).drop("_new"), "neardup-rows")
    found: list[DataFrame] = []
    tiles: list[DataFrame] = []
    met: DataFrame | None = None
    for level in range(1, DEPTH + 1):
        most = SMALL << (level - 1)
        stats = (rows.groupBy("path", "label").agg(F.count("*").alias("c")).groupBy("path")
                 .agg(F.sum("c").alias("members"), F.sum(F.col("c") * F.col("c")).alias("same"), F.max(F.struct("c", "label")).alias("major"))
                 .where("members * members > same")
                 .select("path", F.col("major.label").alias("major"), "members", F.expr("members - major.c").alias("others"),
                         F.expr("(members * members - same) / 2 / members").alias("load")))
        opened = scratch(rows.join(stats, "path").withColumn("small", F.expr(f"load <= {most}" if level < DEPTH else "true")), "neardup-open")
        discard(rows)
        rows = opened
        small, large = rows.where("small"), rows.where("not small").drop("major", "members", "others", "load", "small")
        if met is None:
            # Which first nodes of a class are compared, and the values that tell who shares them.
            mask = small.groupBy("node").agg(F.expr("bit_or(shiftleft(1, root))").alias("mask"))
            met = classes.select("node", F.slice("values", 1, TREES * BRANCH).alias("roots")).join(mask, "node", "left")
            met = scratch(met.withColumn("mask", F.coalesce("mask", F.lit(0))), "neardup-met")
            before = "i < x.root"
        else:
            before = "true"
        small = small.join(met, "node")
        many, small = small.where(F.col("load") > FEW), small.where(F.col("load") <= FEW)
        tiles.append(scratch(_tiles(many, level == 1, percent).withColumn("tile", F.monotonically_increasing_id()), "neardup-tiles"))
        # Each pair once: of different labels, one side not of the node's largest label, and not in
        # a compared first node that comes before this one.
        x, y = small.where("label <> major").alias("x"), small.alias("y")
        undecided = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.major")) | (F.col("x.node") < F.col("y.node")))
        again = F.expr(f"exists(sequence(0, {TREES * BRANCH - 1}), i -> {before} AND (shiftright(x.mask, i) & 1) = 1 AND x.roots[i] = y.roots[i])")
        pairs = x.join(y, (F.col("x.path") == F.col("y.path")) & undecided & _alike("x", "y", percent) & ~again)
        found.append(scratch(_pairs(pairs).distinct(), "neardup-pairs"))
        if large.isEmpty():
            break
        rows = scratch(_children(large.drop("root"), classes), "neardup-rows")
        discard(opened)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    pairs = scratch(pairs.distinct().join(compared[0].union(compared[1]), ["a", "b"], "left_anti"), "neardup-candidates")
    discard(*found, *compared, opened, met)
    nodes = _ends(pairs)
    for some in tiles:
        nodes = nodes.union(some.select(F.explode(F.concat("xs", "ys"))))
    texts = _texts(docs, classes, nodes, id_col, text_col)
    links = _confirm(pairs, texts, size, percent).select("a", "b")
    for some in tiles:
        links = links.union(_tile_links(some, texts, size, percent))
    # What the pivots have linked is one star for each component found so far.
    links = scratch(links.union(near.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b")), "neardup-links")
    discard(pairs, texts, *tiles)
    return links


def _pivot_pairs(docs: DataFrame, classes: DataFrame, rows: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """Each node's members compared with two pivots: any one of them, then the one most like it. Both tables of pairs (a, b), and the linked ones."""
    first = F.min(F.struct(F.xxhash64("path", "node").alias("h"), "node", "n", "s")).alias("p")
    pivots = rows.groupBy("path").agg(first, F.count("*").alias("members")).where("members > 1")
    pivots = scratch(pivots.select("path", "p.node", "p.n", "p.s"), "neardup-pivots")

    def near(pivots: DataFrame) -> DataFrame:
        x, y = rows.alias("x"), pivots.alias("y")
        return x.join(y, (F.col("x.path") == F.col("y.path")) & (F.col("x.node") != F.col("y.node")) & _alike("x", "y", percent))
    seen = scratch(near(pivots).select(F.col("x.path").alias("path"), F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"),
                                       F.col("x.node").alias("node"), F.col("x.n").alias("n"), F.col("x.s").alias("s")), "neardup-near")
    pairs = scratch(seen.select("a", "b").distinct(), "neardup-candidates")
    texts = _texts(docs, classes, _ends(pairs), id_col, text_col)
    told = scratch(_confirm(pairs, texts, size, percent), "neardup-told")
    best = F.max(F.struct("similarity", "node", "n", "s")).alias("p")
    second = seen.join(told, ["a", "b"]).groupBy("path").agg(best).select("path", "p.node", "p.n", "p.s")
    # Only members that a first pivot came near have a text here; later levels see to the others.
    known = texts.select("node")
    more = _pairs(near(second)).distinct().join(pairs, ["a", "b"], "left_anti")
    more = more.join(known.withColumnRenamed("node", "a"), "a", "left_semi").join(known.withColumnRenamed("node", "b"), "b", "left_semi")
    more = scratch(more.select("a", "b"), "neardup-candidates")
    linked = scratch(told.unionByName(_confirm(more, texts, size, percent)).select("a", "b"), "neardup-told")
    discard(pivots, seen, texts, told)
    return (pairs, more), linked


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, key, n_shingles, label (names the component), component_id, kept.

    Words are runs of anything but white space, A-Z as a-z; a document's set holds its distinct
    ``size``-word shingles, or all its words as one if it has fewer. Documents are linked whose sets
    reach a Jaccard similarity of ``percent`` / 100, confirmed on full sets; ``component_id`` is the
    smallest id reachable over links, ``kept`` says whether it is the row's own. Null, empty and
    blank texts have no set, are linked with nothing and kept (label null). Ids must be integers; a
    null id never is a component's smallest unless all its ids are null. Rows with equal ids are
    separate documents. Other columns are ignored; an empty table gives no rows.
    """
    made = scratch(sketches(docs, id_col, text_col, size), "neardup-sketches")
    # Null ids sort last. A class is named when it is written, not by an id: other texts may have the same.
    rep = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("rep")
    classes = (made.where("n > 0").groupBy("h1", "h2")
               .agg(rep, F.first("n").alias("n"), F.first("s").alias("s"), F.first("values").alias("values"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = scratch(classes, "neardup-classes")
    slim = scratch(made.select("id", "key", "n", "h1", "h2"), "neardup-sets")
    discard(made)
    made = slim
    links = similarity_links(docs, classes, id_col, text_col, size, percent)
    labels = connected_components(links)
    discard(links)
    named = classes.select("h1", "h2", "node", "rep.id").join(labels, "node", "left").select("h1", "h2", "id", F.coalesce("label", "node").alias("label"))
    named = scratch(named, "neardup-named")
    discard(classes, labels)
    component = named.groupBy("label").agg(F.min("id").alias("component_id"))
    named = named.drop("id").join(component, "label")
    alone = made.where("n = 0").select("id", "key", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("label"),
                                       F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    told = (made.where("n > 0").select("id", "key", F.col("n").alias("n_shingles"), "h1", "h2").join(named, ["h1", "h2"])
            .select("id", "key", "n_shingles", "label", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))
    return told.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, all columns as they were."""
    told = near_duplicates(docs, id_col, text_col, size, percent).where("kept")
    told = scratch(told.groupBy("label", "id", "key").agg(F.count("*").alias("copies")), "neardup-kept")
    alone = told.where("label is null").select("id", "key", "copies")
    first = told.where("label is not null").groupBy("label", "id").agg(F.min(F.struct("key", "copies")).alias("k"))
    return keep_rows(docs, alone.unionByName(first.select("id", "k.key", "k.copies")), id_col, text_col)
