"""Alignment of two tokenizers: perfect hash, units against whole texts, corpus counts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import alignment, queries
from tidemark.llm.common import table
from tidemark.llm.perfect_hash import PerfectHash

SF = "/root/testdata/sf0.001"
PATHS = [queries.tokenizer_path(name) for name in queries.ALIGNED]


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).choice(50_257 * 32_000, size=n, replace=False)
    index = PerfectHash(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(n))


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError):
        PerfectHash(np.array([1, 2, 1]))


def whole(text):
    """A's ids, B's ids, groups and links of a text, tokenized in one piece; None without tokens."""
    known = alignment.aligner(*PATHS)
    if not text:
        return None
    raw = (" " + text).encode()
    a, b = known.a.encode(" " + text, add_special_tokens=False).ids, known.b.encode(text)
    if b"".join(known.a_bytes[i] for i in a) != raw or b"".join(known.b_bytes[i] for i in b) != raw:
        return None
    ends_a, ends_b = (np.cumsum([len(x[i]) for i in ids]).tolist() for x, ids in ((known.a_bytes, a), (known.b_bytes, b)))
    place_a, place_b = ({end: i for i, end in enumerate(x)} for x in (ends_a, ends_b))
    groups, links, at_a, at_b = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = place_a[end] + 1, place_b[end] + 1
        groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
        links.append((a[to_a - 1], b[to_b - 1]))
        at_a, at_b = to_a, to_b
    return a, b, groups, links


def expected(rows):
    told = [(i, whole(t)) for i, t in rows]
    counts = Counter(link for _, w in told if w for link in w[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, w in told:
        if w is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            a, b, groups, links = w
            out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                        sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return Counter(out)


def result(df, id_col="id"):
    return Counter(map(tuple, df.select(id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()))


def aligned(docs):
    return alignment.align(docs, alignment.count_pairs(docs, *PATHS), *PATHS)


def test_query_equals_whole_texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert result(queries.QUERIES["op11_pair_alignment"](spark, SF), "doc_id") == expected(rows)


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert result(aligned(odd_docs)) == expected(rows)


SIGNS = " \n\r\t\u2003\u2581ab1.')}\u00f1\u65e5\u200b\xa0\x1c\u0301\u180e"


def odd_texts():
    draw = random.Random(5)
    texts = ["trail ", " lead", "\n", "  ", "a\r\nb\r\n  c", ");\r\n}\r\n", "\u2581 x", "<|endoftext|> <s> </s> <0x41>", "a\x00b", "don't  we'll"]
    texts += ["".join(draw.choice(SIGNS) for _ in range(draw.randint(1, 40))) for _ in range(400)]
    return texts + [" ".join(texts[:60]), "plain words, " * 200]


def test_odd_characters(make_docs):
    """White space of all kinds, signs that stand for blanks, names of special tokens."""
    docs = make_docs(list(enumerate(odd_texts())))
    assert result(aligned(docs)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize(("name", "value"), [("BLOCK", 40), ("MEMORY", 9), ("HELD", 30)])
def test_parts_and_forgetting_change_nothing(monkeypatch, name, value):
    monkeypatch.setattr(alignment, name, value)
    known, texts, said = alignment.Aligner(*PATHS), odd_texts(), {}
    for at, begins, valid, block in alignment._read(known, texts):
        for k, (row, units, _, _) in enumerate(block):
            text, fine, links = said.get(row, ("", True, Counter()))
            numbers = at[begins[k]:begins[k] + len(units)]
            keys, n = alignment._links(known, numbers)
            for key, m in zip(keys.tolist(), n.tolist()):
                links[divmod(key, known.width)] += m
            said[row] = text + "".join(known.strings[i] for i in numbers), fine and bool(valid[k]), links
    for row, text in enumerate(texts):
        w = whole(text)
        assert said[row][1] == (w is not None)
        if w:
            assert said[row][0][:-1] == ";".join(w[2]) and said[row][2] == Counter(w[3])


def test_vectors_are_summed_over_several_levels(spark, make_docs, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 2)
    monkeypatch.setattr(alignment, "SLOTS", 8)
    docs = make_docs([(i, "the same words in every text " * (i % 5)) for i in range(200)]).repartition(9)
    counts = alignment.count_pairs(docs, *PATHS)
    links = Counter(link for i in range(200) if (w := whole("the same words in every text " * (i % 5))) for link in w[3])
    assert {(r["a"], r["b"]): r["n"] for r in alignment.pair_table(spark, counts).collect()} == links


def test_foreign_pairs_are_noticed(make_docs):
    counts = alignment.count_pairs(make_docs([(1, "one text")]), *PATHS)
    assert counts.lookup(np.array([1, 2, 3])).tolist() == [-1, -1, -1]
    assert sorted(counts.lookup(counts.keys).tolist()) == list(range(len(counts.keys)))
    with pytest.raises(Exception, match="another corpus"):
        alignment.align(make_docs([(1, "quite different words")]), counts, *PATHS).collect()


def test_empty_table(make_docs):
    assert aligned(make_docs([])).count() == 0
