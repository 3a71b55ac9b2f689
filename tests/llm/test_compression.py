"""The compression classifier: held-out accuracy, sizes against plain compression, odd rows."""

import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import compression, queries
from tidemark.llm.common import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return compression.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_rows_are_told_apart(spark):
    """Accuracy, kept good and caught bad texts, and calibration on rows that trained nothing."""
    told = queries.QUERIES["op13_compression_quality"](spark, SF)
    rows = told.join(table(spark, SF, "labels").select("doc_id", "quality"), "doc_id").where("held_out and quality is not null").toPandas()
    assert told.count() == table(spark, SF, "documents").count() and len(rows) > 800
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"])
    good, yes = rows["quality"] == 1, rows["predicted"] == 1
    assert (good == yes).mean() > 0.98 and yes[good].mean() > 0.98 and (~yes)[~good].mean() > 0.95
    assert rows["score"].between(0, 1).all() and ((rows["score"] >= 0.7) == yes).all()
    assert abs(rows["score"].mean() - good.mean()) < 0.02


def test_sizes_are_those_of_the_whole_text(model):
    sizes, text = compression.Sizes(model.good, model.bad), "Some words, thé same every time. " * 700

    def plain(body):
        known = zstandard.ZstdCompressionDict(body)
        packer = zstandard.ZstdCompressor(level=compression.LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)
        raw = text.encode()
        return sum(len(packer.compress(raw[i:i + 512])) for i in range(0, len(raw), 512))
    assert sizes.of(text) == (plain(model.bad) - plain(model.good), len(text.encode()))
    assert sizes.of(None) == sizes.of("") == (0, 0)


def test_labels_of_held_out_rows_change_nothing(spark, model):
    labels = table(spark, SF, "labels").withColumn(
        "quality", F.when(compression.fold(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = compression.fit(table(spark, SF, "documents"), labels)
    assert again.good == model.good and again.bad == model.bad and np.array_equal(again.weights, model.weights)


def test_calibration_finds_the_shares():
    draw = np.random.default_rng(3)
    more, size = draw.normal(0, 20, 4000).round(), np.full(4000, 1000)
    y = draw.random(4000) < 1 / (1 + np.exp(-(0.1 * more + 0.5)))
    p = compression.Model(b"", b"", compression.calibrate(more, size, y.astype(float))).score(more, size)
    for lo in (0.2, 0.4, 0.6, 0.8):
        mine = (p >= lo) & (p < lo + 0.1)
        assert abs(y[mine].mean() - p[mine].mean()) < 0.08


def scores(docs, model):
    return [(r["id"], r["size"], r["score"]) for r in compression.score(docs, model).collect()]


def test_odd_rows(odd_docs, model):
    rows = scores(odd_docs, model)
    assert len(rows) == odd_docs.count() and all(0 <= s <= 1 for _, _, s in rows)
    by_id = {}
    for i, n, s in rows:
        by_id.setdefault(i, set()).add((n, s))
    assert by_id[1] == by_id[2] and {n for n, _ in by_id[1]} == {0}
    assert by_id[6] == by_id[7] and len(by_id[8]) == 1 and len(by_id[9]) == 2
    assert {n for n, _ in by_id[6]} == {len("lorem ipsum dolor sit amet ") * 20_000}


@pytest.mark.parametrize(("label", "expected"), [(1, lambda s: s > 0.7), (0, lambda s: s < 0.3), (None, lambda s: s == 0.5)])
def test_one_class_or_none(spark, make_docs, label, expected):
    docs = make_docs([(i, f"text number {i}") for i in range(20)] + [(None, "no id"), (3, None), (4, "same id, other text")])
    labels = spark.createDataFrame([(i, label) for i in [*range(20), None]], "doc_id long, quality int")
    assert all(expected(s) for _, _, s in scores(docs, compression.fit(docs, labels)))


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert scores(make_docs([]), compression.fit(make_docs([]), none)) == []
    assert [s for _, _, s in scores(make_docs([(1, "a text")]), compression.fit(make_docs([]), none))] == [0.5]
