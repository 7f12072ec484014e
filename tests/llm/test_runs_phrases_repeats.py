import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from claimloom.llm import periodic_runs, phrases, queries, repeated_bytes
from claimloom.llm.packing import Encoder
from tests.llm.helpers import awkward, empty, frame, prose


def plain_runs(words):
    """Every lag scanned over all words."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(6, 4 * period):
                found.setdefault((at, length), period)
            at = max(end, at + 1)
    return sorted(((start, length, period) for (start, length), period in found.items()), key=lambda run: (run[0], run[2]))


def rhythmic(draw):
    words = []
    while len(words) < draw.choice([0, 5, 60, 400]):
        group = [draw.choice("abcdefgh") + str(draw.randrange(draw.choice([1, 40]))) for _ in range(draw.choice([1, 2, 3, 7, 8, 9, 16, 17, 33, 60]))]
        words += group * draw.choice([1, 2, 4, 5]) + group[: draw.randrange(len(group) + 1)]
        words += [draw.choice("xyz") for _ in range(draw.randrange(9))]
    return words


def test_runs_are_those_of_all_lags(spark):
    draw = random.Random(4)
    texts = [" ".join(rhythmic(draw)) for _ in range(120)] + ["a " * 5, "a " * 6, "ab  cd\tab cd ab\ncd ab cd"]
    found = {r["doc_id"]: r for r in periodic_runs.word_runs(frame(spark, texts)).collect()}
    assert any(run["period"] > 16 for r in found.values() for run in r["runs"])
    for number, text in enumerate(texts):
        runs = plain_runs(text.split())
        assert [tuple(run) for run in found[number]["runs"]] == runs
        dropped = {at for start, length, period in runs for at in range(start + period, start + length)}
        assert found[number]["collapsed"] == " ".join(w for at, w in enumerate(text.split()) if at not in dropped)


def test_runs_do_not_depend_on_portions():
    draw = random.Random(5)
    texts = [" ".join(rhythmic(draw)) for _ in range(40)]
    numbers = periodic_runs._numbered([text.encode() for text in texts])[1]
    assert [runs for one in numbers for runs in periodic_runs.find_runs([one])] == periodic_runs.find_runs(numbers)
    ranges = list(periodic_runs._portions([text.encode() for text in texts], 50))
    assert len(ranges) > 5 and [at for pair in ranges for at in range(*pair)] == list(range(len(texts)))


def test_run_query_plants_and_digests(spark, monkeypatch):
    texts = [prose(n, 40 + n) for n in range(60)]
    docs = frame(spark, texts)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    planted = 0
    for r in queries.op12_periodic_runs(spark, "").collect():
        words, digest = texts[r["doc_id"]].split(), zlib.crc32(str(r["doc_id"]).encode())
        if digest % 10 == 0:
            group = digest // 10
            start = group % len(words)
            period = 1 + (len(words) - start) // (3 + group % 8)
            words = [w if at < start else words[start + (at - start) % period] for at, w in enumerate(words)]
            planted += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda run: (-run[1], run[0], run[2])) if runs else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        dropped = {at for a, b, c in runs for at in range(a + c, a + b)}
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w for at, w in enumerate(words) if at not in dropped).encode()).hexdigest()
    assert planted


def plain_phrases(texts, langs):
    counts = Counter()
    for text, lang in zip(texts, langs):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts[lang or "und", 0, ""] += len(words)
            for k in range(1, 5):
                counts.update((lang or "und", k, " ".join(words[at : at + k])) for at in range(len(words) - k + 1))
    return counts


def sentences(seed, n):
    draw = random.Random(seed)
    common = ["New York city", "of the", "in the middle of", "once upon a time", "a b"]
    return "".join(draw.choice(common + [draw.choice("pqrstuv") * 2]) + draw.choice([" ", " ", ", ", ".\n", "\t", "\r! "]) for _ in range(n))


@pytest.mark.parametrize("least, sample, sample_least", [(30, 4, 2), (6, 2, 1), (3, 10**9, 1), (4, 1, 40)])
def test_frequent_phrases_are_exact_whatever_the_sample(spark, monkeypatch, least, sample, sample_least):
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "TEXT_BYTES_AT_ONCE", 300)
    monkeypatch.setattr(phrases, "WORDS_AT_ONCE", 200)
    texts = [sentences(n, 30 + n) for n in range(40)] + ["loop " * 60, None, "", " . ", "ünï çødé, ünï çødé. Ünï"]
    langs = {n: ["en", "fr", None][n % 3] for n in range(len(texts))}
    found = {(r["lang"], r["k"], r["phrase"]): r["f"] for r in phrases.frequent_phrases(frame(spark, texts, langs), least, sample, sample_least).collect()}
    wanted = plain_phrases(texts, [langs[n] for n in range(len(texts))])
    assert {key: n for key, n in found.items() if n} == {key: n for key, n in wanted.items() if n and (n >= least or key[1] == 0)}


def test_blocks_of_hashes_are_small_and_come_back():
    draw = np.random.default_rng(1)
    ends = np.array([0, (1 << phrases.HASH_BITS) - 1], np.uint64)
    for size, most in ((0, 20), (500_000, 5)):
        hashes = np.unique(np.r_[draw.integers(0, 1 << phrases.HASH_BITS, size, dtype=np.uint64), ends])
        counts = draw.integers(1, 4, len(hashes))
        counts[0] = (1 << 32) - 1
        blocks = phrases._blocks(hashes, counts).to_pydict()
        assert len(set(blocks["range"])) == len(blocks["range"])
        parts = [phrases._unpacked(n, block) for n, block in zip(blocks["range"], blocks["block"], strict=True)]
        assert np.array_equal(np.concatenate([h for h, _ in parts]), hashes.astype(np.int64))
        assert np.array_equal(np.concatenate([f for _, f in parts]), counts)
        # a row of hash and sum took about 9 bytes of a shuffle
        assert len(pa.compress(b"".join(blocks["block"]), codec="lz4_raw", asbytes=True)) < most * len(hashes)


def test_sums_do_not_depend_on_portions(spark, monkeypatch):
    texts = [prose(n, 40) for n in range(30)]
    found = []
    for most in (1, 50, 10**6):
        monkeypatch.setattr(phrases, "HASHES_AT_ONCE", most)
        monkeypatch.setattr(phrases, "WORDS_AT_ONCE", 100)
        found.append(sorted(map(tuple, phrases._hash_counts(frame(spark, texts).select("lang", "text"), (b"\xff",) * 3, 4, 2).collect())))
    assert found[0] and found[0] == found[1] == found[2]


def test_collocations_by_hand(spark):
    rows = [("en", 0, "", 10_000)] + [("en", 1, w, f) for w, f in (("a", 100), ("b", 60), ("c", 50), ("d", 40))]
    rows += [("en", 2, "a b", 50), ("en", 2, "b c", 45), ("en", 2, "c d", 30), ("en", 3, "a b c", 41), ("en", 3, "b c d", 30)]
    rows += [("en", 4, "a b c d", 30), ("xx", 0, "", 5)]
    found = [tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, phrases.COUNTS)).orderBy("rank").collect()]
    # of the cuts of "a b c d" that after "a" is lowest: 30 of 100 + 30; the shorter phrases but "a b c" are covered
    assert found == [
        ("en", 1, "a b c", 41, 100, 45, 10_000, 2_000_000 * 41 // 145), ("en", 2, "a b c d", 30, 100, 30, 10_000, 2_000_000 * 30 // 130)]


def test_phrases_of_awkward_rows(spark):
    assert phrases.frequent_phrases(empty(spark)).count() == 0
    assert phrases.collocations(phrases.frequent_phrases(empty(spark))).count() == 0
    assert phrases.collocations(phrases.frequent_phrases(awkward(spark))).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain_removal(texts):
    """Marks of bytes in strings of 200 bytes that start twice or more."""
    data = [(text or "").encode() for text in texts]
    counts = Counter(text[at : at + 200] for text in data for at in range(len(text) - 199))
    result = []
    for text in data:
        gone = bytearray(len(text))
        for at in range(len(text) - 199):
            if counts[text[at : at + 200]] > 1:
                gone[at : at + 200] = b"\1" * 200
        result.append((text, gone))
    return result


def test_removed_bytes_are_those_of_all_strings(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "BYTES_AT_ONCE", 1500)
    draw = random.Random(8)
    shared = [prose(100 + n, 60) for n in range(6)]
    texts = []
    for n in range(50):
        parts = [prose(n * 10 + k, draw.randrange(3, 50)) for k in range(3)]
        for _ in range(draw.randrange(3)):
            passage = draw.choice(shared)
            begin = draw.randrange(0, 100)
            parts.insert(draw.randrange(len(parts)), passage[begin : begin + draw.choice([150, 198, 199, 200, 201, 202, 230, 400])])
        texts.append(draw.choice([" ", ""]).join(parts))
    texts += [texts[0], texts[0], texts[1] + "end", texts[2][3:], "y" * 199, "y" * 200, "z" * 201, "ab" * 150, "é" * 99, "ñü" * 70, "ñü" * 71 + "q", None, ""]
    # copies edited in different places, which share their surroundings only in part
    texts += [texts[3][:at] + "#" + texts[3][at + 1 :] for at in range(20, len(texts[3]), 37)]
    found = {r["doc_id"]: r for r in repeated_bytes.without_repeats(frame(spark, texts)).collect()}
    for number, (text, gone) in enumerate(plain_removal(texts)):
        assert bytes(found[number]["kept"]) == bytes(b for b, mark in zip(text, gone) if not mark), number
        runs = [(m.start(), m.end() - m.start()) for m in re.finditer(b"\1+", bytes(gone))]
        assert [tuple(span) for span in found[number]["spans"]] == runs


def test_removal_finds_what_bitmaps_let_through_by_chance(spark, monkeypatch):
    monkeypatch.setattr(repeated_bytes, "FILTER_BITS", 1 << 15)
    texts = [prose(n, 300) for n in range(30)] + [prose(3, 290) + " tail", prose(50, 20) + prose(7, 200)]
    found = repeated_bytes.without_repeats(frame(spark, texts)).collect()
    wanted = plain_removal(texts)
    assert {r["doc_id"]: len(r["kept"]) for r in found} == {n: len(text) - sum(gone) for n, (text, gone) in enumerate(wanted)}


@pytest.mark.parametrize("operator, made", [(periodic_runs.word_runs, ["runs", "collapsed"]), (repeated_bytes.without_repeats, ["spans", "kept"])])
def test_awkward_rows_and_names(spark, operator, made):
    docs = awkward(spark)
    for new in (["row", "digest", "rank"], ["place", "n", "ranges"]):
        named = docs.withColumnsRenamed(dict(zip(["score", "chunk", "shard"], new)))
        found = operator(named)
        assert [c for c in found.columns if c not in made] == [c for c in named.columns if c in found.columns]
        assert found.count() == docs.count()
    assert operator(empty(spark)).count() == 0


def test_encoder_takes_long_runs_of_blanks():
    encoder = Encoder(*queries.tokenizer(), special_ids=True)
    for text in (" " * 999_998, " " * 1_000_000, "\n" * 1_000_001 + "a"):
        wanted = encoder.reference.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == wanted
