"""Phrase collocations by sampling and an exact full count (Toivonen's method).

A phrase of 1 to 4 words is frequent if it occurs at least ``LEAST`` times in texts of its language.

1. *Sample.*  Words and pairs of one document in ``SAMPLE`` (by hash of the text) are counted; those with
   ``SAMPLE_LEAST`` occurrences there are proposed.
2. *Full pass.*  Every word is counted, and every longer phrase whose first and last part (all words but
   one) are proposed or, from three words on, counted: the proposals and their negative border.
3. *Closing.*  Words and pairs of the border that turn out frequent let in phrases that the full pass did not count.  One
   more pass counts these, and whatever they let in turn, together with all phrases found frequent.  A phrase
   can only be frequent if its parts are, and every part is either known or counted here, so nothing is left open.

The full pass adds up hashes of ``HASH_BITS`` bits: a task sends sorted blocks of them, one for each of ``1 << RANGE_BITS``
ranges of hashes, and each range is summed by itself; a larger corpus wants more ranges.  The closing pass counts by the words themselves, so results are exact:
phrases that share a hash are only looked at for nothing.  What tasks know of earlier passes is one bitmap for each
phrase length, ``FILTER_BITS`` bits at any size of corpus; a phrase let in by an equal bit can't change results
either, so a larger corpus only wants a larger bitmap.  Tasks count portions of about ``WORDS_AT_ONCE`` words (a
long text is divided between pieces, which phrases never cross), so memory is bounded and frequent phrases are
combined before the exchange.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimloom.llm.common import written

LEAST = 30
LONGEST = 4
SAMPLE = 8
SAMPLE_LEAST = 2
SAMPLE_LONGEST = 2
TOP = 2000
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
# of a hash that is summed; fewer make rows smaller, more let fewer phrases in for nothing
HASH_BITS = 40
RANGE_BITS = 11
# of a hash that blocks hold as they are; the rest are differences
LOW_BITS = 16
HASHES_AT_ONCE = 1_500_000
FILTER_BITS = 1 << 24
BLOCK_BITS = 1 << 14
WORDS_AT_ONCE = 250_000
ROWS_AT_ONCE = 1000
TEXT_BYTES_AT_ONCE = 6 * WORDS_AT_ONCE

BORDER = b"\xff"  # never part of UTF-8
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_NORMAL = bytes(0xFF if i in _PIECE_ENDS else i + 32 if ord("A") <= i <= ord("Z") else i for i in range(256))

COUNTS = "lang string, k int, phrase string, f long"

Bitmaps = tuple[bytes, ...]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    return values


def _has_bit(bitmap: bytes, hashes: np.ndarray) -> np.ndarray:
    bits = (hashes >> np.uint64(2)) & np.uint64(8 * len(bitmap) - 1)
    return (np.frombuffer(bitmap, np.uint8)[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _tokens(texts: Iterable[bytes], most: int, most_bytes: int) -> Iterator[list[bytes]]:
    """Words with a border after each piece, in portions that end with a border."""
    part: list[bytes] = []
    for text in texts:
        text = text.translate(_NORMAL)
        begin = 0
        while begin < len(text):
            end = len(text)
            if end - begin > most_bytes:
                cut = text.find(BORDER, begin + most_bytes)
                end = cut + 1 if cut >= 0 else end
            # blanks other than 0x20 and 0x09 are borders by now
            part += text[begin:end].replace(BORDER, b" \xff ").split()
            part.append(BORDER)
            begin = end
            if len(part) >= most:
                yield part
                part = []
    if part:
        yield part


class Portion:
    """Words of a portion as numbers, and hashes of the phrases that start at each place, length by length."""

    def __init__(self, tokens: list[bytes], lang: str):
        from xxhash import xxh64_intdigest

        numbers: dict[bytes, int] = {BORDER: 0}
        self.tokens = tokens
        self.ids = np.array([numbers.setdefault(token, len(numbers)) for token in tokens], dtype=np.int32)
        words = np.fromiter((xxh64_intdigest(word) for word in numbers), np.uint64, len(numbers))
        self.words = _mixed(words ^ np.uint64(xxh64_intdigest(lang.encode())))[self.ids]
        self.k, self.inside, self._plain = 1, self.ids != 0, self.words

    @property
    def hashes(self) -> np.ndarray:
        """The two lowest bits hold the length less one."""
        return (self._plain & np.uint64((1 << HASH_BITS) - 4)) | np.uint64(self.k - 1)

    def grow(self) -> None:
        """On to phrases of one word more."""
        self._plain = _mixed(self._plain[:-1] * np.uint64(0xA0761D6478BD642F) + self.words[self.k :])
        self.inside = self.inside[:-1] & self.inside[1:]
        self.k += 1


def _both(flags: np.ndarray) -> np.ndarray:
    """Whether both parts of each phrase of one word more have the flag."""
    return flags[:-1] & flags[1:]


def _summed(portion: Portion, let_in: Bitmaps, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and counts of all words, and of longer phrases whose parts are let in (those of any length beyond the bitmaps')."""
    counted = portion.inside
    while True:
        hashes = portion.hashes
        yield np.unique(hashes[counted], return_counts=True)
        if portion.k == longest or len(hashes) < 2:
            return
        allowed = counted & _has_bit(let_in[portion.k - 1], hashes) if portion.k <= len(let_in) else counted
        portion.grow()
        counted = _both(allowed)


def _named(portion: Portion, let_in: Bitmaps, frequent: Bitmaps) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """``k, phrases, counts`` of what may be frequent: phrases counted before with their bit in ``frequent``, and those
    that weren't counted before and whose parts may be frequent."""
    counted = open_ = portion.inside
    while True:
        k, hashes = portion.k, portion.hashes
        open_ = open_ & (~counted | _has_bit(frequent[k - 1], hashes))
        at = np.flatnonzero(open_)
        _, first, inverse = np.unique(hashes[at], return_index=True, return_inverse=True)
        like = at[first][inverse]
        # phrases of equal hash are one if their words are
        same = np.ones(len(at), dtype=bool)
        for place in range(k):
            same &= portion.ids[at + place] == portion.ids[like + place]
        counts = np.bincount(inverse[same], minlength=len(first))
        places, counts = np.concatenate([at[first], at[~same]]), np.concatenate([counts, np.ones(int((~same).sum()), np.int64)])
        yield k, [b" ".join(portion.tokens[place : place + k]) for place in places.tolist()], counts
        if k == LONGEST or len(hashes) < 2:
            return
        allowed = counted & _has_bit(let_in[k - 1], hashes) if k <= len(let_in) else counted
        portion.grow()
        counted, open_ = _both(allowed), _both(open_)


def _portions(batch: pa.RecordBatch, most: int, most_bytes: int) -> Iterator[tuple[str, list[bytes]]]:
    for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
        rows = batch.slice(begin, ROWS_AT_ONCE)
        langs = rows.column(0).to_pylist()
        texts = rows.column(1).cast(pa.binary())
        for lang in sorted(set(langs)):
            own = pa.array(np.flatnonzero([known == lang for known in langs]))
            for tokens in _tokens((text.as_py() or b"" for text in texts.take(own)), most, most_bytes):
                yield lang, tokens


def _added(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order with the sums of their counts."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    return hashes[starts], np.add.reduceat(counts[order], starts)


def _planes(values: np.ndarray) -> np.ndarray:
    """Bytes of each value by row; all first bytes, then all second ones, leave long runs of zeros."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4)


def _blocks(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """``range, block``: distinct hashes in order and their counts, below 2^32, cut into blocks of one range each."""
    ranges = (hashes >> np.uint64(HASH_BITS - RANGE_BITS)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, ranges[1:] != ranges[:-1]])
    high = (hashes >> np.uint64(LOW_BITS)).astype(np.int64)
    steps = np.diff(high, prepend=0)
    steps[starts] = high[starts] - (ranges[starts] << (HASH_BITS - RANGE_BITS - LOW_BITS))
    low, steps, counts = (hashes & np.uint64((1 << LOW_BITS) - 1)).astype("<u2"), _planes(steps), _planes(counts)
    blocks = [
        low[i:j].tobytes() + steps[i:j].T.tobytes() + counts[i:j].T.tobytes()
        for i, j in zip(starts.tolist(), [*starts[1:].tolist(), len(hashes)], strict=True)
    ]
    return pa.RecordBatch.from_arrays([pa.array(ranges[starts].astype(np.int32)), pa.array(blocks, pa.binary())], names=["range", "block"])


def _unpacked(number: int, block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of a block of range ``number``."""
    size = len(block) // 10
    whole = np.frombuffer(block, np.uint8)
    values = lambda begin: np.ascontiguousarray(whole[begin : begin + 4 * size].reshape(4, size).T).view("<u4").ravel()
    high = (number << (HASH_BITS - RANGE_BITS - LOW_BITS)) + np.cumsum(values(2 * size).astype(np.int64))
    return high << LOW_BITS | whole[: 2 * size].view("<u2"), values(6 * size).astype(np.int64)


def _hash_counts(texts: DataFrame, let_in: Bitmaps, longest: int, least: int) -> DataFrame:
    """``h, f``: sums of phrases by hash, of ``least`` or more."""
    shared = texts.sparkSession.sparkContext.broadcast(let_in)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for lang, tokens in _portions(batch, WORDS_AT_ONCE, TEXT_BYTES_AT_ONCE):
                for part in _summed(Portion(tokens, lang), shared.value, longest):
                    waiting.append(part)
                    size += len(part[0])
                if size >= HASHES_AT_ONCE:
                    yield _blocks(*_added(*map(np.concatenate, zip(*waiting, strict=True))))
                    waiting, size = [], 0
        if size:
            yield _blocks(*_added(*map(np.concatenate, zip(*waiting, strict=True))))

    def summed(blocks: pa.Table) -> pa.Table:
        parts = [_unpacked(n, block) for n, block in zip(blocks["range"].to_pylist(), blocks["block"].to_pylist(), strict=True)]
        hashes, counts = _added(*map(np.concatenate, zip(*parts, strict=True)))
        enough = counts >= least
        return pa.table({"h": pa.array(hashes[enough]), "f": pa.array(counts[enough])})

    return texts.mapInArrow(run, "range int, block binary").groupBy("range").applyInArrow(summed, "h long, f long")


def _phrase_counts(texts: DataFrame, let_in: Bitmaps, frequent: Bitmaps) -> DataFrame:
    """``lang, k, phrase, f`` of all phrases that may be frequent, by their words; all words together under ``k = 0``."""
    shared = texts.sparkSession.sparkContext.broadcast((let_in, frequent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, tokens in _portions(batch, WORDS_AT_ONCE, TEXT_BYTES_AT_ONCE):
                portion = Portion(tokens, lang)
                total = (0, [b""], portion.inside.sum(keepdims=True))
                for k, phrases, counts in (total, *_named(portion, *shared.value)):
                    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(phrases), np.int32)))
                    yield pa.RecordBatch.from_arrays(
                        [langs, pa.array(np.full(len(phrases), k, np.int32)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))],
                        names=["lang", "k", "phrase", "f"],
                    )

    return texts.mapInArrow(run, COUNTS).groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f"))


def _bitmaps(hashes: DataFrame, lengths: int) -> Bitmaps:
    """A bitmap for each phrase length: blocks are filled by tasks, and only their fixed number of bytes reaches the driver."""
    bits = hashes.select((F.col("h").bitwiseAND(3)).alias("k"), F.shiftrightunsigned("h", 2).bitwiseAND(FILTER_BITS - 1).alias("bit")).distinct()
    # at most BLOCK_BITS distinct bits a block
    blocks = bits.groupBy("k", F.expr(f"bit div {BLOCK_BITS}").alias("block")).agg(F.collect_list((F.col("bit") % BLOCK_BITS).cast("int")).alias("bits"))
    maps = [np.zeros(FILTER_BITS // 8, np.uint8) for _ in range(lengths)]
    for row in blocks.toLocalIterator():
        part = np.zeros(BLOCK_BITS, np.uint8)
        part[row["bits"]] = 1
        begin = row["block"] * BLOCK_BITS // 8
        maps[row["k"]][begin : begin + BLOCK_BITS // 8] = np.packbits(part, bitorder="little")
    return tuple(part.tobytes() for part in maps)


def frequent_phrases(docs: DataFrame, least: int = LEAST, sample: int = SAMPLE, sample_least: int = SAMPLE_LEAST) -> DataFrame:
    """``lang, k, phrase, f`` of every phrase of 1 to 4 words that occurs ``least`` times or more in its language.

    Rows with ``k = 0`` hold the number of word occurrences of a language.  ``docs`` has ``lang``
    (null: ``und``) and ``text`` (null: empty); other columns are ignored, repeated rows count each, an empty table gives no rows.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    drawn = texts.filter(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0)
    everything = (b"\xff",) * (SAMPLE_LONGEST - 1)
    proposed = _bitmaps(_hash_counts(drawn, everything, SAMPLE_LONGEST, sample_least), SAMPLE_LONGEST)
    frequent = _bitmaps(_hash_counts(texts, proposed, LONGEST, least), LONGEST)
    return written(_phrase_counts(texts, proposed, frequent).filter((F.col("k") == 0) | (F.col("f") >= least)), "phrases")


def _part(words: Column, begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def _exact(column: Column) -> Column:
    return column.cast("decimal(27,0)")


def collocations(frequent: DataFrame, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two words or more, from ``frequent_phrases``.

    The score of a cut is ``floor(2000000 a / (l + r))``; the lowest cut counts, then the earliest.  Phrases inside a
    longer one that occurs at least 80 % as often are left out.  Ranked by score, then ``a``, both descending, then phrase.
    """
    words = F.split("phrase", " ")
    candidates = frequent.filter("k > 1").withColumnRenamed("f", "a").withColumn("words", words)
    cuts = candidates.select(
        "lang", "phrase", "a", "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select(
        "lang", "phrase", "a", "cut",
        _part(F.col("words"), 1, F.col("cut")).alias("first"), _part(F.col("words"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    known = frequent.filter("k > 0").select("lang", F.col("phrase").alias("part"), "f")
    left, right = known.toDF("lang", "first", "l"), known.toDF("lang", "rest", "r")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn(
        "score", F.expr(f"(cast(a as decimal(27,0)) * {SCORE_SCALE}) div (cast(l as decimal(27,0)) + r)")
    )
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("worst"))

    lengths = F.sequence(F.lit(2), F.col("k") - 1)
    inner = F.flatten(F.transform(lengths, lambda n: F.transform(
        F.sequence(F.lit(1), F.col("k") - n + 1), lambda at: _part(F.col("words"), at, n))))
    covering = candidates.filter("k > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
    covering = covering.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = _exact(F.col("longer")) * 100 >= _exact(F.col("a")) * COVERED_PERCENT
    totals = frequent.filter("k = 0").select("lang", F.col("f").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return (
        lowest.join(covering, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
        .select("lang", "phrase", "a", "worst.l", "worst.r", F.col("worst.score").cast("long").alias("score"))
        .withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
        .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
