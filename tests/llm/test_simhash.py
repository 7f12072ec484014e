import random
import re

import numpy as np
import xxhash

from claimloom.llm import simhash
from claimloom.llm.components import components
from tests.llm.helpers import awkward, empty, frame, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_fingerprint(text):
    words = plain_words(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5)]
    edges += [(draw.randrange(2000, 2300), draw.randrange(2000, 2300)) for _ in range(150)]
    draw.shuffle(edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    wanted = plain_groups({n for e in edges if e[0] != e[1] for n in e}, edges)
    assert found == wanted
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def fingerprints(seed):
    """Random values, and a thick cluster around one of them."""
    draw = random.Random(seed)
    values = [draw.getrandbits(64) for _ in range(60)]
    values += [values[0] ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(150)]
    values += [v ^ (1 << draw.randrange(64)) for v in values[1:20]]
    return sorted({int(np.uint64(v).astype(np.int64)) for v in [*values, 0, (1 << 64) - 1]})


def test_links_are_complete_either_way(spark, monkeypatch):
    values = fingerprints(1)
    unsigned = [v % (1 << 64) for v in values]
    edges = [(values[a], values[b]) for a in range(len(values)) for b in range(a) if (unsigned[a] ^ unsigned[b]).bit_count() <= 2]
    wanted = plain_groups(values, edges)
    for cell in (64, 0, 100_000):
        monkeypatch.setattr(simhash, "CELL", cell)
        links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"))
        pairs = [(r["u"], r["v"]) for r in links.collect()]
        assert all(((a % (1 << 64)) ^ (b % (1 << 64))).bit_count() <= 2 for a, b in pairs)
        assert plain_groups(values, pairs) == wanted


def test_embedding_is_a_lower_bound(spark):
    draw = random.Random(2)
    pairs = [(draw.getrandbits(64) - (1 << 63), draw.getrandbits(64) - (1 << 63)) for _ in range(200)]
    rows = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", simhash.distance(simhash.embedding(simhash.F.col("a")), simhash.embedding(simhash.F.col("b"))).alias("bound")
    )
    for r in rows.collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        segments = [(a >> 2 * s & 3, b >> 2 * s & 3) for s in range(32)]
        assert r["bound"] == sum(abs(x.bit_count() - y.bit_count()) for x, y in segments) <= (a ^ b).bit_count()


def test_near_groups_against_brute_force(spark):
    docs = awkward(spark)
    rows = docs.select("doc_id", "text").collect()
    found = simhash.near_groups(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"]) for r in found) == sorted(
        (r["doc_id"] is None, r["doc_id"] or 0, format(plain_fingerprint(r["text"]), "016x")) for r in rows
    )
    prints = sorted({plain_fingerprint(r["text"]) for r in rows})
    groups = plain_groups(prints, [(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 2])
    least = {}
    for r in rows:
        root = groups[plain_fingerprint(r["text"])]
        if r["doc_id"] is not None:
            least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
    for r in found:
        assert r["component_id"] == least.get(groups[int(r["fingerprint"], 16)])
    assert simhash.near_groups(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    draw = random.Random(9)
    texts = [prose(n, 80 + n) for n in range(20)]
    for n in range(12):
        words = texts[0].split()
        words[draw.randrange(len(words))] = f"edit{n}"
        texts.append(" ".join(words))
    texts += [texts[3].upper(), texts[4] + " ending", "short", "short", "", None, "  "]
    docs = frame(spark, texts)
    marks = [plain_fingerprint(text) for text in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if (marks[a] ^ marks[b]).bit_count() <= 2]
    kept = simhash.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(plain_groups(range(len(texts)), near).values()))


def test_repeated_rows_leave_one(spark):
    docs = awkward(spark).withColumnRenamed("score", "key").withColumnRenamed("chunk", "digest").withColumnRenamed("shard", "row")
    kept = [(r["doc_id"], r["text"]) for r in simhash.without_near_copies(docs).collect()]
    assert len(kept) == len(set(kept))
    assert [i for i, t in kept if not (t or "").strip()] == [0]
    assert [i for i, t in kept if t == "one"] == [3]
    assert simhash.without_near_copies(empty(spark)).count() == 0
