"""The Merkle manifest against plain trees built row by row."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, queries
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def said(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """The levels of a tree; a proof is a list of (left, right) digests by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    def proof(i):
        out = []
        for level in levels[:-1]:
            begin = i // 16 * 16
            out.append(("".join(level[begin:i]), "".join(level[i + 1:begin + 16])))
            i //= 16
        return out
    return levels[-1][0], proof


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, said(r), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names]
    if not trees:
        return Counter()
    root, over = tree([t[0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            sides = trees[k][1](i) + over(k)
            found = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                found = (*r[:4], r[4].translate(LOWER))
            node = said(found)
            for left, right in sides:
                node = h(left + node + right)
            out.append((r[0], leaf, trees[k][0], root, h("".join(a + b for a, b in sides)), node, node == root))
    return Counter(out)


def result(df, id_col="id"):
    return Counter(map(tuple, df.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()))


def fields(docs):
    return [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]


def proofs(docs):
    return merkle.proofs(docs, changed=merkle.tampered(docs))


def test_query_equals_plain_trees(spark):
    told = result(queries.QUERIES["op12_merkle_octopus"](spark, SF), "doc_id")
    assert told == plain(fields(table(spark, SF, "documents")))
    assert {r[-1] for r in told} == {True, False}


def test_odd_rows(odd_docs):
    assert result(proofs(odd_docs)) == plain(fields(odd_docs))


def test_many_levels_sources_and_lone_rows(spark):
    """A source of several leaf partitions, one of exactly a partition, runs of one, 300 sources, a null source."""
    rows = spark.range(10_200).select(
        F.col("id").alias("doc_id"), F.expr("CASE WHEN id < 4113 THEN 'a' WHEN id < 8209 THEN 'b' WHEN id < 8300 THEN NULL"
                                            " WHEN id < 8599 THEN concat('s', id) ELSE concat('é', id % 7) END").alias("source"),
        F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text"))
    assert result(proofs(rows)) == plain(fields(rows))


def test_equal_rows_are_leaves_of_their_own(spark):
    rows = spark.range(500).select(F.expr("id % 3").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
                                   F.lit(None).cast("long").alias("n_chars"), F.expr("concat('T', id % 2)").alias("text"))
    assert result(proofs(rows)) == plain(fields(rows))


def test_empty_table(make_docs):
    assert proofs(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_missing_is_the_smallest_union(seed):
    """What single proofs need together, without what follows from the known leaves."""
    draw = random.Random(seed)
    size = draw.choice([1, 2, 16, 17, 256, 300, 5000])
    known = draw.sample(range(size), draw.randint(1, min(size, 40)))
    needed, derived = set(), {(0, p) for p in known}
    for p in known:
        level = 0
        while merkle.width(size, level) > 1:
            begin = p // 16 * 16
            needed |= {(level, q) for q in range(begin, min(begin + 16, merkle.width(size, level))) if q != p}
            p, level = p // 16, level + 1
            derived.add((level, p))
    assert merkle.missing(np.array(known), size) == sorted(needed - derived)
