import zlib

import numpy as np

import corpus_pipeline
from claimloom.llm import packing, queries
from claimloom.llm.queries import tokenizer
from tests.llm.helpers import frame, prose

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y \n", "<|endoftext", None, prose(1, 300) + "<|endoftext|>" + prose(2, 900)]


def wanted():
    """Ids by ``tokenizers`` with the vocabulary file as it stands."""
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer()[0])
    return [[*reference.encode(text or "", add_special_tokens=False).ids, packing.SEPARATOR] for text in TEXTS]


def test_special_strings_get_their_ids(spark):
    assert wanted()[0] == [64, 220, 50256, 275, packing.SEPARATOR]
    found = packing.pack_documents(frame(spark, TEXTS), *tokenizer(), special_ids=True).toPandas()
    for doc, ids in enumerate(wanted()):
        pieces = found[found["doc_id"] == doc].sort_values("start")
        assert np.frombuffer(b"".join(pieces["ids"]), dtype="<u4").tolist() == ids


def test_query_and_pipeline_give_special_ids(spark, monkeypatch):
    docs = frame(spark, TEXTS)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    for found in (queries.op4_packing(spark, ""), corpus_pipeline.packed_documents(spark, docs, "")):
        for r in found.collect():
            ids = wanted()[r["doc_id"]]
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
