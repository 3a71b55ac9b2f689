"""Exact and near duplicates against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from conftest import SF

from tidemark.llm import components, exact_dedup, neardup, queries


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for doc, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc is None, doc or 0, doc))
    return groups


def test_exact_against_brute_force(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = queries.op10_exact_dedup(spark, SF).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for norm, group in brute_exact(zip(docs.doc_id, docs.text)).items():
        keep = min(group)[3]
        for *_, doc in group:
            r = got.loc[doc]
            assert (r.keep_id, r.group_size, r.kept) == (keep, len(group), doc == keep)
            assert r.text_sha256 == hashlib.sha256(norm.encode()).hexdigest()


def test_exact_odd_rows(odd_docs):
    got = exact_dedup.exact_duplicates(odd_docs).toPandas()
    assert len(got) == 16 and got.kept.sum() == 10
    empty = got[got.group_size == 4]
    assert len(empty) == 4 and empty[empty.kept].id.tolist() == [3]
    named = got[got.group_size == 2]
    assert len(named) == 6 and sorted(named[named.kept].id.tolist()) == [6, 8, 11]
    assert exact_dedup.drop_duplicates(odd_docs).count() == 10
    assert exact_dedup.drop_duplicates(odd_docs).columns == odd_docs.columns


def test_exact_empty_table(odd_docs):
    none = odd_docs.where("false")
    assert exact_dedup.exact_duplicates(none).count() == 0 and exact_dedup.drop_duplicates(none).count() == 0


def test_exact_leaves_unread_what_length_and_prefix_settle(make_docs):
    got = exact_dedup.exact_duplicates(make_docs([(1, "abc"), (2, "abcd"), (3, "abce"), (4, "a b c d")])).toPandas().set_index("id")
    assert got.digest.isna().to_dict() == {1: True, 2: False, 3: True, 4: False}


def brute_near(rows, size, percent):
    sets = {}
    for k, (doc, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[k] = {tuple(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()
    by = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            by[x].append(k)
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    common = collections.Counter((a, b) for ks in by.values() for i, a in enumerate(ks) for b in ks[i + 1:])
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    low = collections.defaultdict(list)
    for k in sets:
        low[root(k)].append(rows[k][0])
    return {rows[k][0]: (len(sets[k]), min(low[root(k)])) for k in sets}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_near_against_brute_force(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    want = brute_near(list(zip(docs.doc_id, docs.text)), 2, 80)
    got = queries.op5_chosen_path(spark, sf).toPandas()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_near_dense_group(make_docs, monkeypatch):
    """A large group of near copies of one text that are not all near each other, in nodes over the limit."""
    monkeypatch.setattr(neardup, "SMALL", 4)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words))]
    for k in range(1, 300):
        own = [f"x{k}_{i}" if (i * 7919 + k * 104729) % 23 == 0 else w for i, w in enumerate(words)]
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, f"nothing in common {k} {k * k} {k * 31}") for k in range(50)]
    want = brute_near(rows, 2, 80)
    got = neardup.near_duplicates(make_docs(rows), size=2).toPandas()
    assert {r.id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want


def dense(n, alike, seed=11):
    """n texts of 400 words, each two of which share about ``alike`` of their words, and their ids."""
    draw = random.Random(seed)
    keep = (2 * alike / (1 + alike)) ** 0.5
    base = [f"w{i}" for i in range(400)]
    return [(k, " ".join(w if draw.random() < keep else f"x{k}_{i}" for i, w in enumerate(base))) for k in range(n)]


def counted(monkeypatch):
    """Rows of every table that the join writes, by name."""
    rows, plain = collections.Counter(), neardup.scratch

    def scratch(df, name):
        out = plain(df, name)
        rows[name] += out.count()
        return out
    monkeypatch.setattr(neardup, "scratch", scratch)
    return rows


@pytest.mark.parametrize("settings", [{}, {"FEW": 0, "SIDE_ROWS": 64}, {"FEW": 0, "SMALL": 40, "SIDE_ROWS": 64}])
def test_near_group_at_the_threshold(make_docs, monkeypatch, settings):
    """Links and pairs just below them in one group: blocks and tiles of any size find what brute force finds."""
    for name, value in settings.items():
        monkeypatch.setattr(neardup, name, value)
    rows = dense(120, 0.745) + [(1000 + k, t) for k, t in dense(60, 0.9, 3)] + [(2000 + k, f"alone {k} {k * k}") for k in range(40)]
    want = brute_near(rows, 1, 80)
    got = neardup.near_duplicates(make_docs(rows), size=1).toPandas()
    assert {r.id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert 1 < len({c for k, (_, c) in want.items() if k < 1000}) < 120


def test_pairs_below_the_threshold_never_become_rows(make_docs, monkeypatch):
    """1,500 texts that are alike by 0.6 to 0.79: over a million undecided pairs, but every table stays in proportion.

    A text has 12 first nodes and at most 24 and 48 on the next two levels, where all nodes are compared.
    """
    rows = counted(monkeypatch)
    docs = make_docs(dense(1500, 0.7))
    got = neardup.near_duplicates(docs, size=1).toPandas()
    assert len(got) == 1500 and got.kept.mean() > 0.9
    assert rows["neardup-tiles"] > 0 and max(rows.values()) < (12 + 24 + 48) * 1500


def test_repeated_rows_are_compared_once(make_docs, monkeypatch):
    """Two near texts, 300 rows each: one pair, two texts."""
    rows = counted(monkeypatch)
    words = [f"w{i}" for i in range(100)]
    docs = [(1, " ".join(words))] * 300 + [(2, " ".join([*words, "end"]))] * 300
    got = neardup.near_duplicates(make_docs(docs), size=2).toPandas()
    assert len(got) == 600 and set(got.component_id) == {1}
    assert rows["neardup-candidates"] == 1 and rows["neardup-texts"] == 2


@pytest.mark.parametrize("most", [5000, 40])
def test_shared_counts_intersections(most):
    """Few pairs one by one, many by products."""
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, most, draw.integers(0, 900)).astype(np.uint64)) for _ in range(9)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(4), np.arange(5), indexing="ij"))
    want = [len(np.intersect1d(sets[a], sets[4 + b])) for a, b in zip(i, j)]
    assert neardup.shared(sets[:4], sets[4:], i, j).tolist() == want
    assert neardup.shared(sets[:4], sets[4:], i[:1], j[:1]).tolist() == want[:1]


def test_near_odd_rows(odd_docs):
    got = neardup.near_duplicates(odd_docs).toPandas()
    assert len(got) == 16
    assert got[got.n_shingles == 0].kept.all() and (got.n_shingles == 0).sum() == 4
    by = got.set_index("id")
    assert by.loc[7].component_id == 6 and not by.loc[7].kept and by.loc[6].kept
    kept = neardup.drop_near_duplicates(odd_docs).toPandas()
    assert kept.doc_id.tolist().count(8) == 1 and 7 not in kept.doc_id.tolist() and kept.text.isna().sum() == 2
    assert (kept.text == "no id here at all").sum() == 1
    assert neardup.near_duplicates(odd_docs.where("false")).count() == 0


def test_near_equal_ids_are_separate_documents(make_docs, odd_docs):
    kept = neardup.drop_near_duplicates(odd_docs).toPandas()
    assert sorted(kept[kept.doc_id == 9].text) == ["one id two texts", "one id, another text"]
    words = [[f"{c}{i}" for i in range(60)] for c in "abc"]
    one, two, three = (" ".join(w) for w in words)
    near_one, near_two = one + " end", two + " end"
    rows = [(1, one), (1, two), (2, near_one), (3, near_two), (3, three), (None, near_two + " z"), (None, "only null ids here")]
    got = neardup.near_duplicates(make_docs(rows)).toPandas()
    assert got.label.nunique() == 4
    assert sorted(got.component_id.fillna(-1)) == [-1, 1, 1, 1, 1, 1, 3] and got.kept.sum() == 4
    kept = neardup.drop_near_duplicates(make_docs(rows)).toPandas()
    assert sorted(kept.text) == sorted([one, two, three, "only null ids here"])


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 500)] + [(1000 + (i * 37) % 101, 1000 + ((i + 1) * 37) % 101) for i in range(100)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).toPandas()
    assert set(got.label) == {0, 1000} and len(got) == 501 + 101
