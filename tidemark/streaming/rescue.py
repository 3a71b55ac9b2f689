"""Keeps what does not fit the schema in a ``_rescued_data`` column instead of losing it."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESCUED = "_rescued_data"
SOURCE_FILE = "_source_file"
_CORRUPT = "_corrupt_record"
_GLOB_CHARS = "\\{}[]*?"
#: Bytes asked for at the beginning of a file, and files opened at a time.
HEADER_BUFFER, HEADER_READERS = 4096, 32


def _literal_path(path: str) -> str:
    """The path with glob characters escaped, so that it names exactly one file."""
    return "".join(f"\\{c}" if c in _GLOB_CHARS else c for c in path)


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a file that is not blank, read up to its end and no further than a buffer beyond."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place, HEADER_BUFFER)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        while (line := reader.readLine()) is not None:
            if line.strip():
                return line
        return None
    finally:
        reader.close()


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of each file, from the first line that is not blank.

    Only the beginning of a file is opened, many files at a time and without a Spark job, so that rows
    are scanned once. ``paths`` is the file list of one micro-batch, whose length the trigger bounds.
    """
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        lines = list(pool.map(lambda p: _first_line(spark, p), paths))
    return {p: _names(line) for p, line in zip(paths, lines)}


def _names(line: str | None) -> tuple[str, ...]:
    """Names of a header line; blank ones are numbered, repeated ones told apart."""
    if line is None:
        return ()
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    named = [n if n.strip() else f"_c{i}" for i, n in enumerate(names)]
    low = [n.lower() for n in named]
    return tuple(n if low.count(k) == 1 else f"{n}{i}" for i, (n, k) in enumerate(zip(named, low)))


def _csv_group(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: T.StructType) -> DataFrame:
    """Files that share a header, with columns bound by name."""
    names = [f"c{i}" for i in range(len(header))]
    raw = (
        spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]]))
        .option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .csv([_literal_path(p) for p in paths])
    )
    by_name: dict[str, str] = {}
    for n, h in zip(names, header):
        by_name.setdefault(h.strip().lower(), n)
    known = [
        F.col(by_name[f.name.lower()]).alias(f.name) if f.name.lower() in by_name
        else F.lit(None).cast("string").alias(f.name)
        for f in schema.fields
    ]
    used = {by_name[f.name.lower()] for f in schema.fields if f.name.lower() in by_name}
    extras = [(h, n) for n, h in zip(names, header) if n not in used] + [(_CORRUPT, _CORRUPT)]
    anything = reduce(Column.__or__, [F.col(n).isNotNull() for _, n in extras])
    rescued = F.when(anything, F.to_json(F.struct(*[F.col(n).alias(h) for h, n in extras])))
    return raw.select(*known, rescued.alias(RESCUED), F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_csv_rescued(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """CSV files of any header: known columns by name, all else in ``_rescued_data``.

    Reordered and missing columns, unknown columns and lines with a wrong number of fields are
    all kept. ``paths`` is the file list of one micro-batch, whose length the trigger bounds.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in csv_headers(spark, paths).items():
        if header:
            groups.setdefault(header, []).append(path)
    frames = [_csv_group(spark, files, header, schema) for header, files in sorted(groups.items())]
    if not frames:
        empty = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields],
                              T.StructField(RESCUED, T.StringType()), T.StructField(SOURCE_FILE, T.StringType())])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, frames)


def _lost_entries(raw: Column, typed: Column, fields: list[T.StructField]) -> Column:
    """Entries of a raw string map that the typed struct does not carry."""
    names = F.array(*[F.lit(f.name) for f in fields])

    def lost(key: Column, value: Column) -> Column:
        unread = reduce(Column.__or__, [(key == f.name) & typed[f.name].isNull() for f in fields])
        return value.isNotNull() & (~F.array_contains(names, key) | unread)

    kept = F.map_filter(raw, lost)
    return F.when(F.size(kept) > 0, kept)


def _present(typed: Column, fields: list[T.StructField]) -> Column:
    """How many fields of a struct hold a value."""
    return reduce(Column.__add__, [F.when(typed[f.name].isNotNull(), 1).otherwise(0) for f in fields])


def _carries_all(typed: Column, whole: Column, schema: T.StructType) -> Column:
    """Whether the typed struct holds every entry of the variant of its line; null where that can't be told.

    A field has a value only if the line has an entry of its name, and a variant repeats no name, so
    equal numbers of both leave no entry over. Entries that are null count too: such lines are looked at
    entry by entry.
    """
    def entries(path: str) -> Column:
        return F.size(F.try_variant_get(whole, path, "map<string,variant>"))

    structs = [f for f in schema.fields if isinstance(f.dataType, T.StructType)]
    if any(not f.name or set(f.name) & set("'\"") for f in structs):
        return F.lit(False)  # no path names such a field
    inner = [typed[f.name].isNull() | (entries(f"$['{f.name}']") == _present(typed[f.name], f.dataType.fields))
             for f in structs]
    return reduce(Column.__and__, [entries("$") == _present(typed, schema.fields), *inner])


def parse_json_rescued(lines: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed columns from JSON lines; malformed lines, unknown keys and values of a wrong type rescued.

    ``_rescued_data`` is a JSON object with what was lost at the top level under ``$`` and inside
    each struct under its name. Only lines that lost something, or hold a null, are taken apart for it.
    """
    text, typed = F.col(value), F.col("_typed")
    parsed = lines.where(F.trim(text) != "").withColumns({
        "_typed": F.from_json(text, schema),
        "_whole": F.try_parse_json(text),
    })
    # Expressions, not columns: they are worked out only in the branch that asks for them.
    raw = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    losses = [_lost_entries(raw, typed, schema.fields).alias("$")]
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            inner = F.from_json(F.element_at(raw, f.name), T.MapType(T.StringType(), T.StringType()))
            losses.append(_lost_entries(inner, typed[f.name], f.dataType.fields).alias(f.name))
    packed = F.to_json(F.struct(*losses))
    rescued = (
        F.when(_carries_all(typed, F.col("_whole"), schema), F.lit(None).cast("string"))
        .when(F.col("_whole").isNull() | raw.isNull(), F.to_json(F.struct(text.alias(_CORRUPT))))
        .when(packed != "{}", packed)
    )
    others = [c for c in lines.columns if c != value]
    return parsed.select(*[F.col(f"_typed.{f.name}").alias(f.name) for f in schema.fields],
                         rescued.alias(RESCUED), *others)
