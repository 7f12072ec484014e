"""Small tables with awkward rows."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, chunk int, shard string"
WORDS = "alpha beta gamma delta omega river stone cloud green quick brown fox jumps over lazy dog night day wind rain".split()


def prose(seed: int, length: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "ing", "er", str(draw.randrange(50))]) for _ in range(length))


def frame(spark, texts, langs=None, ids=None):
    """Documents with columns whose names clash with results, in several partitions."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None, 0.5, 1, "x") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


def awkward(spark):
    """Null and blank texts, null and repeated ids, repeated rows, ties, one very long text."""
    texts = [None, "", "   \n ", "one", "one", "Two words", "ünï çødé ñ", "a b c d e f", "A  b c\td e f", prose(1, 6000), prose(2, 40), prose(2, 40), "x" * 50_000]
    return frame(spark, texts, ids=[0, 1, 2, 3, 3, None, 6, 7, 8, 9, 10, 10, 12])


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
