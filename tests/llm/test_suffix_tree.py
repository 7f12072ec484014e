import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd

from claimloom.llm import suffix_tree
from claimloom.llm.common import held_out
from tests.conftest import SMALL
from tests.llm.helpers import awkward, empty, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), "\n"]


def plain_scores(rows):
    """The same tree in dictionaries; rows are ``(held_out, text)``."""
    texts = [(out, tokens(text)) for out, text in rows]
    grams = Counter()
    for out, words in texts:
        if not out:
            for size in (1, 2, 3):
                grams.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    total = sum(n for g, n in grams.items() if len(g) == 1)
    distinct = sum(1 for g in grams if len(g) == 1)
    root = lambda n: (n - 0.5 if n > 0 else 0.5 * distinct) / total if total else 1.0
    mixed = lambda n, c, p, w: (n + (w[0] + w[1] * c) * p) / (c + w[0] + w[1] * c)
    gains = {}
    for out, words in texts:
        if out:
            continue
        for i in range(1, len(words)):
            low = root(grams[(words[i],)] - 1)
            one = (words[i - 1],)
            pairs = [(one, low)]
            if i > 1:
                parent = mixed(grams[(*one, words[i])] - 1, grams[one] - 1, low, suffix_tree.WEIGHTS[-1])
                pairs.append(((words[i - 2], *one), parent))
            for context, base in pairs:
                if grams[context] >= suffix_tree.LEAST_CONTEXT:
                    for k, w in enumerate(suffix_tree.WEIGHTS):
                        gain = math.log(mixed(grams[(*context, words[i])] - 1, grams[context] - 1, base, w) / base)
                        gains.setdefault(context, [0, 0])[k] += round(gain * suffix_tree.GAIN_STEPS)
    kept = {c: int(np.argmax(g)) for c, g in gains.items() if max(g) > suffix_tree.KEEP * suffix_tree.GAIN_STEPS}
    out = []
    for _, words in texts:
        score = 0.0
        for i, word in enumerate(words):
            p = root(grams[(word,)])
            for size in (1, 2):
                context = tuple(words[i - size : i]) if i >= size else None
                if context in kept:
                    p = mixed(grams[(*context, word)], grams[context], p, suffix_tree.WEIGHTS[kept[context]])
            score += math.log10(p)
        base = sum(math.log10((grams[(w,)] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        out.append((len(words), sum(grams[(w,)] > 0 for w in words), total, base, score))
    return out, kept


def check(spark, texts, held):
    docs = frame(spark, texts).drop("score")
    out = docs.sparkSession.createDataFrame(list(enumerate(held)), "doc_id long, held_out boolean")
    found = {r["doc_id"]: r for r in suffix_tree.score_texts(docs.join(out, "doc_id")).collect()}
    wanted, kept = plain_scores(list(zip(held, texts)))
    for doc, row in enumerate(wanted):
        r = found[doc]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (*row[:3], held[doc])
        assert math.isclose(r["base_score"], row[3], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(r["score"], row[4], rel_tol=1e-6, abs_tol=1e-6)
    return kept


def corpus():
    texts = [prose(i, 60) for i in range(40)] + ["to be or not to be that is the question " * (i % 3 + 1) for i in range(30)]
    return [*texts, None, "", "Unseen words only here"], [i % 5 == 1 for i in range(70)] + [False, True, True]


def test_scores_equal_a_plain_tree(spark):
    kept = check(spark, *corpus())
    assert {len(c) for c in kept} == {1, 2}


def test_scores_do_not_depend_on_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(suffix_tree, "KEYS_PER_RANGE", 500)
    check(spark, *corpus())


def test_given_documents_score_alike_in_chunks_of_any_size(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("held_out", held_out("doc_id", 5, 1))
    scores = []
    for tokens, keys in ((2_000_000, 2_000_000), (3_000, 20_000)):
        monkeypatch.setattr(suffix_tree, "CHUNK_TOKENS", tokens)
        monkeypatch.setattr(suffix_tree, "KEYS_PER_RANGE", keys)
        scores.append(suffix_tree.score_texts(docs).toPandas().sort_values("doc_id"))
    assert len(scores[0]) and scores[0]["n_in_context"].tolist() == scores[1]["n_in_context"].tolist()
    assert np.allclose(scores[0]["score"], scores[1]["score"], rtol=1e-12)


def test_probabilities_of_known_and_unknown_words_sum_to_one():
    counts = np.array([5, 1, 3, 1])
    corpus_ = suffix_tree.Corpus(int(counts.sum()), len(counts))
    assert math.isclose(corpus_.root(np.r_[counts, 0]).sum(), 1.0)


def test_keys_and_counts_survive_packing():
    draw = np.random.default_rng(1)
    for keys in (np.array([7], np.uint64), np.unique(draw.integers(0, 1 << 63, 1000, dtype=np.uint64)), np.arange(5, 900, dtype=np.uint64)):
        assert (suffix_tree._unpacked_keys(suffix_tree._packed_keys(keys)) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 70_000])
    assert (suffix_tree._unpacked_counts(suffix_tree._packed_counts(counts), len(counts)) == counts).all()
    sums = np.array([0, -1, 32767, -32767, 32768, -32768, 10**12, -(10**12)])
    for part, blob in zip(parts := [slice(0, 5), slice(5, 8)], suffix_tree._packed_sums(sums.astype(float), parts)):
        assert (suffix_tree._unpacked_sums(blob, part.stop - part.start) == sums[part]).all()


def test_awkward_empty_and_untrained(spark):
    from pyspark.sql import functions as F

    docs = awkward(spark)
    found = suffix_tree.score_texts(docs.withColumn("held_out", F.lit(False)))
    rows = found.collect()
    assert len(rows) == 13 and sum(r["doc_id"] is None for r in rows) == 1
    assert all(r["score"] <= 0 and r["n_tokens"] == r["n_known"] for r in rows)
    unlearned = suffix_tree.score_texts(docs.withColumn("held_out", F.lit(True))).collect()
    assert {r["score"] for r in unlearned} == {0.0} and {r["train_tokens"] for r in unlearned} == {0}
    assert suffix_tree.score_texts(empty(spark).withColumn("held_out", F.lit(True))).count() == 0


def test_a_chunk_takes_few_numbers_a_token():
    """Peak of the steps over one chunk, in bytes a token; places of 64 bits and both levels at once took 132 and 210."""
    draw = np.random.default_rng(3)
    tokens, vocabulary = 200_000, np.unique(draw.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    places = np.minimum(draw.pareto(0.6, tokens) * 20, len(vocabulary) - 1).astype(np.uint32)
    row = {"chunk": 1, "words": vocabulary.tobytes(), "places": places.tobytes(),
           "lengths": np.full(tokens // 100, 100).tobytes(), "held": np.zeros(tokens // 100, dtype=bool).tobytes()}
    ranges = suffix_tree.Ranges(1, 40)
    asked = suffix_tree._table(suffix_tree._count_requests(suffix_tree.Chunk(row, 40), ranges))
    replies = pd.concat([suffix_tree._added_counts(group) for _, group in asked.groupby(["kind", "number"])])
    tracemalloc.start()
    try:
        chunk = suffix_tree.Chunk(row, 40)
        made = tracemalloc.get_traced_memory()[1] / tokens
        rows = suffix_tree.View(chunk, replies, suffix_tree.Corpus(tokens, len(vocabulary)), ranges).gains()
        judged = tracemalloc.get_traced_memory()[1] / tokens
    finally:
        tracemalloc.stop()
    assert rows and made < 90 and judged < 165, (made, judged)
