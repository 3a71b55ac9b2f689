"""Exact duplicates by progressive refinement: length, then a prefix hash, then the whole content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_rows, scratch, text_key

#: Normalised characters that the second step hashes.
PREFIX_CHARS = 256
#: Hash slots of the map of open groups: 64 rows of 4 KB, whatever the size of the corpus.
MAP_BITS = 64 * 32768


def normal(text: Column) -> Column:
    """Null as empty; blanks, tabs and line ends deleted."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def _open_map(keys: DataFrame) -> DataFrame:
    """(bucket, bits) of the slots that ``slot`` names: at most 64 rows of 4 KB."""
    return (keys.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")))


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(MAP_BITS))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, key, keep_id, group_size, kept, digest.

    Texts are equal when they are identical without blanks, tabs and line ends; null counts as empty.
    The row with the longest original text stays, then the smallest id (null ids last). Rows that
    repeat both id and text are told apart: exactly one row of every group is kept.

    1. One scan makes (length, prefix hash) of each row; lengths that occur once leave.
    2. Of the others, (length, prefix hash) pairs that occur once leave.
    3. A second scan reads whole texts, and hashes those whose pair is still open. A bitmap of fixed
       size says which; two pairs that share a slot cost a hash more, never a wrong group.
       ``digest_all`` fills ``digest`` (SHA-256 of the normalised text) for the other rows too.

    Groups are counted with partial aggregation; a group that holds a third of the rows is split by
    the skew join that hands its result back. ``key`` is the MD5 of the original text. An empty
    table gives an empty result. Other columns of docs are ignored.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    text = normal(F.col("t"))
    sketch = (base.select(text.alias("n"))
              .select(F.length("n").alias("len"), F.xxhash64(F.substring("n", 1, PREFIX_CHARS)).alias("prefix"))
              .groupBy("len", "prefix").count())
    sketch = scratch(sketch, "dedup-prefix")
    lengths = sketch.groupBy("len").agg(F.sum("count").alias("n")).where("n > 1").select("len")
    opened = sketch.join(lengths, "len", "left_semi").where("count > 1").select(_slot(F.col("len"), F.col("prefix")).alias("slot"))
    bits = F.broadcast(_open_map(opened))

    full = (base.select("id", text.alias("n"), text_key(F.col("t")).alias("key"),
                        F.length(F.coalesce("t", F.lit(""))).alias("chars"))
            .withColumn("len", F.length("n"))
            .withColumn("slot", _slot(F.col("len"), F.xxhash64(F.substring("n", 1, PREFIX_CHARS)))))
    full = full.join(bits, F.bitmap_bucket_number(full["slot"]) == bits["bucket"], "left")
    position = F.bitmap_bit_position("slot")
    byte = F.conv(F.hex(F.substring("bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_open = F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
    digest = F.sha2(F.col("n"), 256)
    full = full.select("id", "key", "chars", "len", is_open.alias("open"),
                       (digest if digest_all else F.when(is_open, digest)).alias("digest"))
    full = scratch(full, "dedup-full")

    closed = full.where("not open").select(
        "id", "key", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest")
    # Rows with the same id and text are one line here, with their number.
    lines = full.where("open").groupBy("id", "key", "chars", "len", "digest").agg(F.count("*").alias("copies"))
    lines = scratch(lines, "dedup-open")
    best = F.min(F.struct(-F.col("chars"), F.col("id").isNull(), "id", "key"))
    groups = (lines.groupBy("len", "digest").agg(F.sum("copies").alias("group_size"), best.alias("best"))
              .select("len", "digest", "group_size", F.col("best.id").alias("keep_id"),
                      F.col("best.key").alias("keep_key")))
    wins = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("key") == F.col("keep_key"))
    told = (lines.join(groups, ["len", "digest"])
            .withColumn("nr", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("id", "key", "keep_id", "group_size", (wins & (F.col("nr") == 1)).alias("kept"), "digest"))
    return closed.unionByName(told)


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    named = exact_duplicates(docs, id_col, text_col)
    keepers = named.groupBy("id", "key").agg(F.count("*").alias("copies"), F.max("kept").alias("kept")).where("kept")
    return keep_rows(docs, keepers, id_col, text_col)
