"""Validated writes, text exports, samples, managed tables and contract schemas."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.errors import ContractError

TYPES = {
    "BOOLEAN": T.BooleanType(),
    "TINYINT": T.ByteType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "VARCHAR": T.StringType(),
    "DECIMAL(18,2)": T.DecimalType(18, 2),
    "DECIMAL(18,4)": T.DecimalType(18, 4),
    "DECIMAL(38,6)": T.DecimalType(38, 6),
}


def table_schema(columns: dict[str, tuple[str, bool]]) -> T.StructType:
    """Schema of ``{column: (contract type, nullable)}``."""
    unknown = sorted({kind for kind, _ in columns.values()} - set(TYPES))
    if unknown:
        raise ContractError(f"unsupported contract types: {', '.join(unknown)}")
    return T.StructType([T.StructField(n, TYPES[kind], nullable) for n, (kind, nullable) in columns.items()])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in contract order and type; a null in a required column fails the job."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in {field.name}")).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop, jvm


VERSIONS = "_versions"
COMMIT = re.compile(r"_commit_(\d{12})_([0-9a-f]{32})")
ABANDONED_MS = 24 * 3_600_000


def _commits(fs, folder) -> list[tuple[int, str]]:
    """Commits of a published table, oldest first; names alone say everything, so none is ever half written."""
    if not fs.exists(folder):
        return []
    found = (COMMIT.fullmatch(status.getPath().getName()) for status in fs.listStatus(folder))
    return sorted((int(match[1]), match[2]) for match in found if match)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the version that the last commit names; None where nothing was published."""
    fs, folder, _ = _file_system(spark, path)
    commits = _commits(fs, folder)
    return f"{path.rstrip('/')}/{VERSIONS}/{commits[-1][1]}" if commits else None


def published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table, or the files of a plain folder."""
    return spark.read.parquet(current_version(spark, path) or path)


def collect_versions(spark: SparkSession, path: str, keep: int = 2, abandoned_ms: int = ABANDONED_MS) -> list[str]:
    """Delete all but the last ``keep`` versions and return the ids deleted.

    The last one but one is kept for readers that resolved it before the last commit.  Versions that no commit
    names go once they are older than ``abandoned_ms``: their writer was lost, or it still runs if they are younger.
    """
    if keep < 1:
        raise ContractError("the current version must be kept")
    fs, folder, jvm = _file_system(spark, path)
    commits = _commits(fs, folder)
    versions = jvm.org.apache.hadoop.fs.Path(folder, VERSIONS)
    former = commits[:-keep]
    for number, version in former:
        # the commit goes first, so that no commit ever names files that are gone
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder, f"_commit_{number:012d}_{version}"), False)
    named, gone = {version for _, version in commits}, [version for _, version in former]
    if fs.exists(versions):
        now = jvm.java.lang.System.currentTimeMillis()
        gone += [s.getPath().getName() for s in fs.listStatus(versions)
                 if s.getPath().getName() not in named and s.getModificationTime() < now - abandoned_ms]
    for version in gone:
        fs.delete(jvm.org.apache.hadoop.fs.Path(versions, version), True)
    return gone


def publish(
    df: DataFrame, path: str, validate: Callable[[DataFrame], None] = lambda written: None,
    row_group_rows: int = 100_000, keep: int = 2,
) -> DataFrame:
    """Write a new version of a table, validate what was written, then commit it.

    A commit is an empty file whose name holds its number and version, so readers (``published``) find either the
    former version or the new one at any moment, and a writer lost at any step leaves the former one current.
    Writers of the same table at the same time are all kept; of equal numbers the greatest id is current.
    Files are compressed with Zstandard in row groups of at most ``row_group_rows`` rows.  A failed validation
    removes the attempt.  ``keep`` versions are kept.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    root = path.rstrip("/")
    attempt = f"{root}/{VERSIONS}/{version}"
    fs, folder, jvm = _file_system(spark, root)
    attempt_path = jvm.org.apache.hadoop.fs.Path(attempt)
    try:
        df.write.option("compression", "zstd").option("parquet.block.row.count.limit", row_group_rows).parquet(attempt)
        validate(spark.read.schema(df.schema).parquet(attempt))
    except Exception:
        fs.delete(attempt_path, True)
        raise
    number = max((n for n, _ in _commits(fs, folder)), default=0) + 1
    if not fs.createNewFile(jvm.org.apache.hadoop.fs.Path(folder, f"_commit_{number:012d}_{version}")):
        raise ContractError(f"cannot publish {path}")
    collect_versions(spark, root, keep)
    return spark.read.schema(df.schema).parquet(attempt)


FOOTER_SCHEMA = (
    "file string, row_group int, row_count bigint, column_name string, codec string, null_count bigint, "
    "smallest string, largest string"
)


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    # imported in the tasks, as only they read footers
    from pyarrow import fs
    from pyarrow import parquet as pq

    for batch in batches:
        rows = []
        for uri in batch["file"]:
            system, path = fs.FileSystem.from_uri(uri)
            with system.open_input_file(path) as source:
                footer = pq.ParquetFile(source).metadata
            for group in range(footer.num_row_groups):
                block = footer.row_group(group)
                for place in range(block.num_columns):
                    column, known = block.column(place), block.column(place).statistics
                    bounds = (str(known.min), str(known.max)) if known is not None and known.has_min_max else (None, None)
                    nulls = known.null_count if known is not None and known.has_null_count else None
                    rows.append((uri, group, block.num_rows, column.path_in_schema, column.compression, nulls, *bounds))
        yield pd.DataFrame(rows, columns=[part.split()[0] for part in FOOTER_SCHEMA.split(", ")])


def parquet_footers(table: DataFrame) -> DataFrame:
    """What the footers of a written table say of each column of each row group; tasks read them, never the rows.

    Files must lie in a file system that Arrow can open.  A table without files gives no rows.
    """
    spark, files = table.sparkSession, table.inputFiles()
    names = spark.createDataFrame([(name,) for name in files], "file string")
    spread = names.repartition(max(1, min(len(files), spark.sparkContext.defaultParallelism)), "file")
    return spread.mapInPandas(_read_footers, FOOTER_SCHEMA)


def load_tables(spark: SparkSession, root: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Required tables under a folder; all missing ones are named together."""
    absent = []
    for name in names:
        fs, path, _ = _file_system(spark, f"{root}/{name}")
        if not fs.exists(path):
            absent.append(name)
    if absent:
        raise ContractError(f"missing tables: {', '.join(absent)}")
    return {name: published(spark, f"{root}/{name}") for name in names}


def export_texts(df: DataFrame) -> DataFrame:
    """Every column as text: floats with four digits, dates in ISO form, booleans as 1 and 0."""
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = value.cast("decimal(38,4)")
        elif isinstance(field.dataType, T.BooleanType):
            value = value.cast("int")
        columns.append(value.cast("string").alias(field.name))
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """Comma-separated UTF-8 with header, LF and empty nulls, sorted by range where an order is given."""
    ordered = df.orderBy(*order) if order else df
    export_texts(ordered).write.mode("overwrite").csv(path, header=True, lineSep="\n", nullValue="", emptyValue="")


def stable_sample(df: DataFrame, key: Sequence[str], rows: int = 25) -> DataFrame:
    """First rows in key order, the published sample of a table."""
    return df.orderBy(*key).limit(rows)


def save_managed(df: DataFrame, schema: str, table: str, file_format: str = "parquet") -> DataFrame:
    """Overwrite a managed table in its domain schema and read it back."""
    spark = df.sparkSession
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    df.write.format(file_format).mode("overwrite").option("overwriteSchema", "true").saveAsTable(f"{schema}.{table}")
    return spark.table(f"{schema}.{table}")
