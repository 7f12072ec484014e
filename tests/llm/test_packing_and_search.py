import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import packing, vector_search
from claimloom.llm.queries import tokenizer
from tests.llm.helpers import awkward, empty, frame, prose


def packed(docs, **options):
    return packing.pack_documents(docs, *tokenizer(), **options).toPandas()


def test_pieces_restore_every_document(spark):
    from tokenizers import Tokenizer

    texts = [None, "", "it's  odd \n\n spacing\t", "<|endoftext|> stays", " é 😀"] + [prose(n, 5 + 37 * n) for n in range(60)]
    found = packed(frame(spark, texts))
    reference = Tokenizer.from_file(tokenizer()[0])
    reference.encode_special_tokens = True
    for doc, text in enumerate(texts):
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, packing.SEPARATOR]
        pieces = found[found["doc_id"] == doc].sort_values("start")
        assert np.frombuffer(b"".join(pieces["ids"]), dtype="<u4").tolist() == ids
        assert pieces["start"].tolist() == [0, *np.cumsum(pieces["length"])[:-1]]
        assert set(pieces["doc_tokens"]) == {len(ids)}
    assert all(zlib.crc32(row.ids) == row.ids_crc32 for row in found.itertuples())
    for _, pieces in found.groupby("sequence_id"):
        pieces = pieces.sort_values("offset")
        assert pieces["offset"].tolist() == [0, *np.cumsum(pieces["length"])[:-1]]
        assert pieces["length"].sum() <= pieces["tier"].iloc[0] <= 1024
    sizes = found.groupby("sequence_id")["length"].sum()
    padding = sum(1024 - n for n in sizes if n & (n - 1))
    assert padding <= 0.01 * sizes.sum()


def test_awkward_and_empty_documents_pack(spark):
    found = packed(awkward(spark), with_ids=False)
    assert found.groupby("doc_id", dropna=False)["length"].sum().loc[0] == 1
    assert found["doc_id"].isna().any()
    assert packed(empty(spark)).empty


def test_steps_are_balanced():
    sequences = [(1024, [packing.Rest(0, 0, bytes(4 * 1024), 1024)]) for _ in range(130)]
    steps = packing.balanced_steps(sequences, 64 * 1024)
    assert sorted(np.bincount(steps).tolist()) == [65, 65]


def test_a_vocabulary_out_of_order_is_refused():
    encoder = packing.Encoder(*tokenizer())
    encoder.fast = type("Other", (), {"encode_to_numpy": lambda self, text, **_: np.array([1], dtype=np.uint32)})()
    with pytest.raises(ValueError):
        encoder.encode("some text")


def brute_nearest(rows, k):
    """``(query_id, rank, vec_id, score)`` of every query row, in order."""
    usable = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, wanted) in enumerate(usable):
        if q % 50 == 0:
            scored = [
                (-round((wanted @ v) / np.linalg.norm(wanted) / np.linalg.norm(v), 12), i)
                for other, (i, v) in enumerate(usable) if other != at and len(v) == len(wanted)
            ]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out)


def test_nearest_vectors_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "CANDIDATES_PER_GROUP", 300)
    monkeypatch.setattr(vector_search, "QUERIES_PER_GROUP", 7)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=16).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(i, [float(i % 7), 1.0] * 8) for i in range(1200, 1500)]  # many ties
    rows += [(1500, None), (1550, []), (1600, [0.0] * 16), (1650, [float("nan")] * 16), (1700, [None] * 16), (None, [1.0] * 16)]
    rows += [(1750, [1.0, 2.0, 3.0]), (1751, [3.0, 2.0, 1.0]), rows[5], rows[50]]
    rows += [rows[150]] * 12  # more copies than are asked for
    rows += [(200, rows[7][1]), (8, rows[250][1]), (9, rows[250][1])]  # other vectors under an id, other ids with a vector
    rows += [(1800, [1e30] * 16), (1850, [1e-30] * 16)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string")
    found = vector_search.nearest_vectors(table, F.col("vec_id") % 50 == 0, 5).toPandas()
    wanted = brute_nearest([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], 5)
    found = sorted(found[["query_id", "rank", "vec_id", "score"]].itertuples(index=False, name=None))
    by_score = lambda table: sorted((q, rank, s) for q, rank, _, s in table)
    assert [r[:2] for r in by_score(found)] == [r[:2] for r in by_score(wanted)]
    assert np.allclose([r[2] for r in by_score(found)], [r[2] for r in by_score(wanted)], atol=1e-8)
    # beyond, equal scores differ in the last digit
    assert [r[:3] for r in found if r[0] < 1200] == [r[:3] for r in wanted if r[0] < 1200]
    assert vector_search.nearest_vectors(table.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
