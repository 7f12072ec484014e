"""Training samples of labelled texts, and functions of whole texts as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 40


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int) -> DataFrame:
    """``text, y`` of about ``rows`` labelled documents at most, chosen by the hash of their ids.

    Only ids for which ``learn`` (a condition on ``doc_id``) holds are used; null labels are left out, and of
    repeated labels of an id the smallest counts.  The chosen labels are at most ``rows`` narrow rows up to
    chance, so they are broadcast and no text is shuffled.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("double").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(HASH_RANGE)) < int(share * HASH_RANGE))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "y")


def with_text_columns(
    docs: DataFrame, compute: Callable[[list[str | None]], list[np.ndarray]], columns: dict[str, str]
) -> DataFrame:
    """``docs`` with ``columns`` (name to type, double or array<double>) that ``compute`` makes of whole texts."""
    kept = docs.columns
    at = kept.index("text")
    arrow = {"double": pa.float64(), "array<double>": pa.list_(pa.float64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                pa.array(values if values.ndim == 1 else list(values), arrow[kind])
                for values, kind in zip(compute(batch[at].to_pylist()), columns.values())
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*kept, *columns])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(run, ", ".join(fields + [f"`{name}` {kind}" for name, kind in columns.items()]))
