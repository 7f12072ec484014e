"""Layers written once and read by every later step.

A layer is a Parquet table in the shared checkpoint folder.  Steps that read the same derived rows
many times (ten rules over the same lines) scan pruned columns of the written table instead of
recomputing it, and a lost executor costs a re-read, not the lineage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimloom.session import ensure_checkpoint_dir

_written: dict[str, dict[str, StructType]] = {}


def _digest(value: object) -> str:
    return hashlib.sha256(repr(value).encode()).hexdigest()[:16]


def input_listing(spark: SparkSession, folder: str) -> list[tuple]:
    """Path, size and time of change of everything directly under a folder and its table folders."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, waiting = [], [root]
    while waiting:
        path = waiting.pop()
        for status in fs.listStatus(path) if fs.exists(path) else ():
            found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
            if status.isDirectory() and path == root:
                waiting.append(status.getPath())
    return sorted(found)


class LayerStore:
    """Written tables of one application, by input files, name and settings."""

    def __init__(self, spark: SparkSession, source: str):
        ensure_checkpoint_dir(spark)
        context = spark.sparkContext
        self.spark = spark
        self.root = f"{context.getCheckpointDir()}/layers/{context.applicationId}/{_digest((source, input_listing(spark, source)))}"

    def keep(self, name: str, build: Callable[[], DataFrame], settings: object = None) -> DataFrame:
        """Write what ``build`` returns under ``name`` and ``settings`` if not yet written, and read it back.

        ``settings`` is everything the rows depend on besides the input; its ``repr`` tells layers apart.  No
        bucketing by claim: a claim holding a large share of rows would fill one bucket, while
        shuffled joins are split when skewed.
        """
        schemas = _written.setdefault(self.root, {})
        layer = name if settings is None else f"{name}-{_digest(settings)}"
        path = f"{self.root}/{layer}"
        if layer not in schemas:
            frame = build()
            frame.write.mode("overwrite").option("compression", "zstd").parquet(path)
            schemas[layer] = frame.schema
        return self.spark.read.schema(schemas[layer]).parquet(path)


class LazyTables(Mapping):
    """Tables of a model or star by name; asking for one builds it and what it needs, nothing else."""

    def __init__(self, model: object, names: Sequence[str]):
        self._model, self._names = model, tuple(names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return getattr(self._model, name)

    def __contains__(self, name: object) -> bool:
        return name in self._names

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)
