"""Annual text files: strict reading, lineage, profiles and drift."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions.hashing import schema_fingerprint

MALFORMED = "_malformed"
LINE_END = "\n"
QUOTE = b'"'
# source encodings whose quotes and line ends are the ASCII bytes; utf-8-sig may start with a byte order mark
ENCODINGS = {"utf-8": "utf-8", "utf-8-sig": "utf-8", "cp1252": "cp1252", "latin-1": "latin-1", "ascii": "ascii"}
BYTE_ORDER_MARK = "\ufeff"
ARROW_KINDS = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string())


def codec(encoding: str) -> str:
    """Python codec of a source encoding."""
    if encoding not in ENCODINGS:
        raise ContractError(f"unsupported source encoding {encoding}")
    return ENCODINGS[encoding]


def decoded(line: bytes, path: str, encoding: str) -> str:
    try:
        return line.decode(codec(encoding))
    except UnicodeDecodeError as error:
        raise ContractError(f"bytes of {path} do not fit {encoding}: {error}") from error


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with their file and the start of the split they were read in, in the order of the file."""
    return spark.read.text(path, lineSep=LINE_END).select(
        F.col("value").cast("binary").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def read_header(spark: SparkSession, path: str, encoding: str = "utf-8") -> list[str]:
    """Column names of a file, or of the first file of a folder."""
    files = [entry for entry in list_entries(spark, path) if not entry.rpartition("/")[2].startswith(("_", "."))]
    first = _lines(spark, files[0]).first()
    if first is None:
        raise ContractError(f"no header in {path}")
    text = decoded(bytes(first["line"]), path, encoding).removeprefix(BYTE_ORDER_MARK).rstrip("\r")
    if text.count('"') % 2:
        raise ContractError(f"line break in the header of {path}")
    return next(csv.reader([text]))


def _splits_inside_quotes(lines: DataFrame) -> set[tuple[str, int]]:
    """Splits that start inside a quoted field: those with an odd number of quotes before them in the file."""
    text = F.col("line").cast("string")
    quotes = F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    # one row for each split of a file
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = counted.withColumn("before", F.sum("quotes").over(before)).filter(F.col("before") % 2 == 1)
    return {(row["file"], row["block"]) for row in odd.select("file", "block").collect()}


def read_records(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """``file, first, record``: records of delimited text, which may hold line breaks inside quotes.

    Files are split between tasks at any line.  Quotes are counted per split first, so each task knows
    whether its splits begin inside a quoted field.  It joins the lines of its records; of a record that crosses
    a split the pieces, at most two a split, are joined afterwards.  ``first`` marks the first record of a file.
    """
    lines = _lines(spark, path)
    inside = _splits_inside_quotes(lines)
    fields = ["file", "block", "place", "kind", "first", "record"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place, kind, open_lines, is_open = None, 0, "whole", [], False
        rows: list[tuple] = []

        def close(kind: str) -> None:
            nonlocal place
            first = kind != "rest" and split[1] == 0 and place == 0
            text = LINE_END.join(open_lines)
            rows.append((*split, place, kind, first, text.removeprefix(BYTE_ORDER_MARK) if first else text))
            open_lines.clear()
            place += 1

        for batch in batches:
            for line, file, block in zip(*(column.to_pylist() for column in batch.columns)):
                if (file, block) != split:
                    if open_lines:
                        close("rest" if kind == "rest" else "start")
                    split, place, is_open = (file, block), 0, (file, block) in inside
                    kind = "rest" if is_open else "whole"
                open_lines.append(decoded(line, file, encoding))
                is_open ^= line.count(QUOTE) % 2 == 1
                if not is_open:
                    close(kind)
                    kind = "whole"
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind_) for values, kind_ in zip(zip(*rows) if rows else [()] * 6, ARROW_KINDS)], names=fields
            )
            rows.clear()
        if open_lines:
            close("rest" if kind == "rest" else "start")
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), ARROW_KINDS)], names=fields)

    read = lines.mapInArrow(records, "file string, block long, place long, kind string, first boolean, record string")
    whole = read.filter("kind = 'whole'").select("file", "first", "record")
    pieces = read.filter("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("block", "place")
    numbered = pieces.withColumn("number", F.count_if(F.col("kind") == "start").over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "record")))
    joined = numbered.groupBy("file", "number").agg(F.max("first").alias("first"), parts.alias("parts")).select(
        "file", "first", F.array_join(F.transform("parts", lambda part: part["record"]), LINE_END).alias("record")
    )
    return whole.unionByName(joined)


def active_aliases(header: Sequence[str], aliases: dict[str, str] | None) -> dict[str, str]:
    """Configured renames that apply to this header; a rename onto another column is an error."""
    active = {}
    for source, target in (aliases or {}).items():
        if source not in header:
            continue
        if target in header and target != source:
            raise ContractError(f"alias target already exists: {source} -> {target}")
        active[source] = target
    return active


def read_text_csv(
    spark: SparkSession,
    path: str,
    source_id: str,
    year: int,
    aliases: dict[str, str] | None = None,
    encoding: str = "utf-8",
    acquired_at: str = "",
) -> DataFrame:
    """Every source column as text plus lineage; malformed rows and undecodable bytes fail the job.

    The checks are part of the rows' own columns, so they run whenever the rows are written.  Blank lines
    outside quotes are left out; every file of a folder starts with the same header.
    """
    # renames may differ by case only, so header names are matched exactly
    header = read_header(spark, path, encoding)
    renames = active_aliases(header, aliases)
    places = [f"_c{at}" for at in range(len(header))]
    schema = ", ".join(f"{name} string" for name in [*places, MALFORMED])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "escape": '"', "maxCharsPerColumn": "-1"}
    record = F.regexp_replace("record", r"\r\z", "")
    rows = read_records(spark, path, encoding).select("file", "first", record.alias("record")).filter("first OR record <> ''")
    parsed = rows.select("file", "first", "record", F.from_csv("record", schema, options).alias("r"))
    quotes = F.length("record") - F.length(F.replace(F.col("record"), F.lit('"'), F.lit("")))
    broken = F.col(f"r.{MALFORMED}").isNotNull() | (quotes % 2 == 1)
    other_header = F.col("first") & ~F.array(*(F.coalesce(F.col(f"r.{name}"), F.lit("")) for name in places)).eqNullSafe(
        F.array(*(F.lit(name) for name in header))
    )
    fail = lambda text: F.raise_error(F.lit(text)).cast("boolean")
    sound = F.when(broken, fail(f"malformed row in {path}")).when(other_header, fail(f"another header in {path}")).otherwise(~F.col("first"))
    return parsed.filter(sound).select(
        *[F.col(f"r.{place}").alias(renames.get(name, name)) for place, name in zip(places, header)],
        F.lit(source_id).alias("_source_id"),
        F.lit(year).alias("_reporting_year"),
        F.element_at(F.split("file", "/"), -1).alias("_source_file"),
        F.lit(acquired_at).alias("_acquired_at_utc"),
    )


def list_entries(spark: SparkSession, folder: str) -> list[str]:
    """Paths directly under a folder of any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise ContractError(f"missing folder {folder}")
    return sorted(status.getPath().toString() for status in fs.listStatus(path))


def discover_annual_files(spark: SparkSession, root: str, source_id: str, years: Sequence[int]) -> dict[int, str]:
    """Exactly one CSV (a file, or a folder of parts named like one) per year under root/source/year."""
    found = {}
    for year in sorted(years):
        files = [f for f in list_entries(spark, f"{root}/{source_id}/{year}") if re.search(r"(?i)\.csv$", f)]
        if len(files) != 1:
            raise ContractError(f"expected one CSV for {source_id} {year}, found {len(files)}")
        found[year] = files[0]
    return found


def land_family(
    spark: SparkSession,
    root: str,
    target: str,
    source_id: str,
    years: Sequence[int],
    aliases: dict[str, str] | None = None,
    encodings: dict[int, str] | None = None,
    acquired_at: str = "",
) -> DataFrame:
    """Land each year as Parquet in its own partition and return the drift inventory.

    Years are written apart, so columns that differ between years stay visible.
    """
    frames = {}
    for year, path in discover_annual_files(spark, root, source_id, years).items():
        rows = read_text_csv(
            spark, path, source_id, year, aliases, (encodings or {}).get(year, "utf-8"), acquired_at
        )
        folder = f"{target}/{source_id}/_reporting_year={year}"
        rows.drop("_reporting_year").write.mode("overwrite").option("compression", "zstd").parquet(folder)
        frames[year] = spark.read.parquet(folder)
    return family_inventory(frames)


def profile(df: DataFrame) -> DataFrame:
    """Position, name, type and nullability of each column, with the table's row count."""
    rows = df.count()
    columns = [
        (i, f.name, f.dataType.simpleString(), f.nullable, rows) for i, f in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        columns, "position int, column_name string, column_type string, is_nullable boolean, row_count bigint"
    )


def family_inventory(frames: dict[int, DataFrame]) -> DataFrame:
    """One row per year: rows, columns, schema signature, and whether the whole family agrees."""
    spark = next(iter(frames.values())).sparkSession
    signatures = {year: schema_fingerprint(df) for year, df in frames.items()}
    described = spark.createDataFrame(
        [
            (year, sum(not c.startswith("_") for c in df.columns), signatures[year],
             len(set(signatures.values())) == 1)
            for year, df in frames.items()
        ],
        "reporting_year int, source_column_count int, schema_signature string, schema_consistent boolean",
    )
    counts = None
    for year, df in frames.items():
        counted = df.agg(F.count("*").alias("row_count")).withColumn("reporting_year", F.lit(year))
        counts = counted if counts is None else counts.unionByName(counted)
    return described.join(F.broadcast(counts), "reporting_year")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The newest row of each key; partial maxima make it safe for keys with very many rows."""
    others = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return newest.select(*keys, "_row.*")
