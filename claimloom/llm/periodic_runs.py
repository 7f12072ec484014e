"""Runs of repeated word groups, found from minimizers at doubling scales.

A run is a stretch of words with smallest period ``q`` and at least ``max(6, 4 q)`` words that no
neighbouring word extends.  Periods below ``DIRECT`` are scanned lag by lag.  For periods from ``P`` to
``2 P`` (``P`` doubles from scale to scale) every group of ``2 P`` words is hashed, and the least hash of each
window of ``P`` groups is its minimizer.  Inside a run of such a period the window minima repeat at period
distance, and since a group is no shorter than the period it recurs there at no other distance.  So two
neighbouring occurrences of one minimizer, ``P`` to ``2 P`` words apart, seed the run; a seed is extended
word by word on both sides.  Words are compared by number, not by hash; hashes only propose seeds.

Documents are handled one Arrow batch at a time inside the scan's partitions, without a shuffle; a text is
never divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

LEAST_WORDS = 6
LEAST_PERIODS = 4
DIRECT = 8
WORDS_AT_ONCE = 500_000
RUNS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "length", "period")]))

Run = tuple[int, int, int]


def _least_length(period):
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period)


def _scatter(values: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit words of ``values``."""
    mixed = (values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def _joined(hashes: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of groups twice as long, from those of their two halves."""
    both = hashes[:-apart] * np.uint64(0xA0761D6478BD642F) + hashes[apart:]
    both ^= both >> np.uint64(31)
    both *= np.uint64(0xE7037ED1A0B428DB)
    return both ^ (both >> np.uint64(30))


def _window(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """Best of every ``width`` neighbours; ``width`` is a power of two."""
    reach = 1
    while reach < width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    return values


def _at_lag(words: np.ndarray, period: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of all long enough stretches with words ``period`` apart equal."""
    same = np.zeros(max(0, len(words) - period) + 2, dtype=np.int8)
    same[1:-1] = words[: len(words) - period] == words[period:]
    edges = np.flatnonzero(np.diff(same))
    starts, lengths = edges[::2], edges[1::2] - edges[::2] + period
    long = lengths >= _least_length(period)
    return starts[long], lengths[long]


def _stretch(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The maximal range around ``at`` whose words equal those ``period`` later."""
    low, high, step = at, at, 64
    while low > 0:
        back = max(0, low - step)
        unlike = np.flatnonzero(words[back:low] != words[back + period : low + period])
        if len(unlike):
            low = back + int(unlike[-1]) + 1
            break
        low, step = back, step * 2
    last, step = len(words) - period, 64
    while high < last:
        on = min(last, high + step)
        unlike = np.flatnonzero(words[high:on] != words[high + period : on + period])
        if len(unlike):
            high += int(unlike[0])
            break
        high, step = on, step * 2
    return low, high


def _seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of neighbouring equal minimizers, ``scale`` to twice as many words apart."""
    least = _window(hashes, scale, np.minimum)
    around = np.zeros(len(least) + 2 * (scale - 1), dtype=np.uint64)
    around[scale - 1 : scale - 1 + len(least)] = least
    chosen = np.flatnonzero(_window(around, scale, np.maximum) == hashes)
    order = chosen[np.argsort(hashes[chosen], kind="stable")]
    apart = np.diff(order)
    found = (hashes[order[1:]] == hashes[order[:-1]]) & (apart >= scale) & (apart < 2 * scale)
    return order[:-1][found], apart[found]


def find_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """Runs ``(start, length, period)`` of each text, by start, then period; texts are arrays of word numbers from 0."""
    lengths = np.array([len(text) for text in texts], dtype=np.int64)
    # a border of its own after each text equals no other word, so nothing extends over it
    words = np.full(int(lengths.sum()) + len(texts), -1, dtype=np.int64)
    ends = np.cumsum(lengths + 1)
    starts = ends - lengths - 1
    for start, text in zip(starts, texts):
        words[start : start + len(text)] = text
    words[ends - 1] = -1 - np.arange(len(texts))

    periods: dict[tuple[int, int], int] = {}
    for period in range(1, DIRECT):
        for start, length in zip(*_at_lag(words, period)):
            periods.setdefault((int(start), int(length)), period)

    scale, size, hashes, place = DIRECT, 1, _scatter(words), np.arange(len(words))
    held = np.repeat(np.arange(len(texts)), lengths + 1)
    while len(hashes):
        stay = (lengths >= LEAST_PERIODS * scale)[held[: len(hashes)]]
        hashes, place, held = hashes[stay], place[: len(stay)][stay], held[: len(stay)][stay]
        while size < 2 * scale and len(hashes) > size:
            hashes = _joined(hashes, size)
            size *= 2
        if size < 2 * scale or len(hashes) < scale:
            break
        at, apart = _seeds(hashes, scale)
        reached: dict[int, int] = {}
        for seed, period in sorted(zip(place[at].tolist(), apart.tolist())):
            if seed < reached.get(period, 0) or words[seed] != words[seed + period]:
                continue
            low, high = _stretch(words, seed, period)
            reached[period] = high
            if high - low + period >= _least_length(period):
                key = (low, high - low + period)
                periods[key] = min(period, periods.get(key, period))
        place, held = place[: len(hashes)], held[: len(hashes)]
        scale *= 2

    found: list[list[Run]] = [[] for _ in texts]
    for (start, length), period in sorted(periods.items(), key=lambda item: (item[0][0], item[1])):
        text = int(np.searchsorted(ends, start, side="right"))
        found[text].append((start - int(starts[text]), length, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words but those that a run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], list[np.ndarray]]:
    numbers: dict[bytes, int] = {}
    # bytes.split() cuts at exactly the ASCII blanks 0x20 and 0x09 to 0x0D
    words = [text.split() for text in texts]
    return words, [np.array([numbers.setdefault(word, len(numbers)) for word in text], dtype=np.int64) for text in words]


def _portions(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` words; a text alone may have more."""
    begin, size = 0, 0
    for at, text in enumerate(texts):
        words = len(text) // 6 + 1
        if size and size + words > most:
            yield begin, at
            begin, size = at, 0
        size += words
    if begin < len(texts):
        yield begin, len(texts)


def word_runs(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` but ``text``, then ``runs`` (by start, then period) and the ``collapsed`` text of every row.

    A null, empty or blank text has no runs and an empty collapsed text.  Repeated rows come out once each,
    an empty table gives no rows.  Other columns, whatever their names, are passed on, but for ``runs`` and ``collapsed``,
    which are replaced.
    """
    kept = [field for field in docs.schema.fields if field.name not in ("text", "runs", "collapsed")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            texts = [value or b"" for value in column.cast(pa.binary()).to_pylist()]
            for begin, end in _portions(texts, WORDS_AT_ONCE):
                words, numbers = _numbered(texts[begin:end])
                runs = find_runs(numbers)
                shorter = [b" ".join(collapsed(*pair)) for pair in zip(words, runs)]
                flat = np.array([run for one in runs for run in one], dtype=np.int64).reshape(-1, 3)
                offsets = np.concatenate([[0], np.cumsum([len(one) for one in runs])]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(flat[:, k].copy()) for k in range(3)], names=["start", "length", "period"])
                columns = [batch.column(k).slice(begin, end - begin) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.ListArray.from_arrays(pa.array(offsets), spans), pa.array(shorter, pa.binary()).cast(pa.string())],
                    names=[*(field.name for field in kept), "runs", "collapsed"],
                )

    returned = StructType([*kept, StructField("runs", RUNS), StructField("collapsed", StringType())])
    return docs.select(*(f"`{f.name}`" for f in kept), F.col("text").cast("string")).mapInArrow(run, returned)
