import random

import numpy as np
from pyspark.sql import functions as F

from claimloom.llm import language_id, quality, toxicity
from claimloom.llm.common import held_out
from claimloom.llm.labelled import labelled_sample
from tests.llm.helpers import awkward, empty, frame, prose

LABELS = "doc_id long, quality int, toxic int, text string"


def table(spark, rows):
    return spark.createDataFrame(rows, LABELS)


def labelled_texts():
    """Clean and bad texts: bad quality shouts, toxic ones insult."""
    draw = random.Random(4)
    texts, rows = [], []
    for i in range(400):
        words = prose(i, 20 + draw.randrange(120)).split()
        good, rude = draw.random() < 0.8, draw.random() < 0.25
        if rude:
            for word in ("idiot", "loser", f"grumble{draw.randrange(9)}"):
                words.insert(draw.randrange(len(words)), word)
        texts.append(" ".join(w if good else w.upper() + "!!" for w in words))
        rows.append((i, int(good), int(rude), "clash"))
    return texts, rows


def test_held_out_follows_the_checksum(spark):
    import zlib

    rows = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("out", held_out("doc_id", 4, 2)).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert spark.sql("select cast(null as long) doc_id").select(held_out("doc_id", 4, 2)).first()[0] is False


def test_sample_is_bounded_and_skips_other_rows(spark):
    docs = frame(spark, ["a"] * 2000)
    labels = table(spark, [(i, 1, None if i % 2 else 0, "") for i in range(2000)] + [(None, 1, 1, ""), (0, 0, 1, "")])
    assert labelled_sample(docs, labels, "quality", F.lit(True), 10_000).count() == 2000
    assert labelled_sample(docs, labels, "toxic", F.lit(True), 10_000).count() == 1000
    assert 50 < labelled_sample(docs, labels, "quality", F.lit(True), 100).count() < 170
    assert labelled_sample(docs, labels, "quality", F.col("doc_id") < 10, 100).agg(F.min("y"), F.count("y")).first() == (0.0, 10)


def test_quality_and_toxicity_on_held_out_rows(spark):
    texts, rows = labelled_texts()
    docs, labels = frame(spark, texts), table(spark, rows)
    for fit, score, threshold, place in (
        (quality.fit_quality, quality.with_quality, quality.THRESHOLD, 1),
        (toxicity.fit_toxicity, toxicity.with_toxicity, toxicity.THRESHOLD, 2),
    ):
        model = fit(docs, labels, ~held_out("doc_id", 4, 2))
        found = score(docs.withColumn("out", held_out("doc_id", 4, 2)), model, "_s").collect()
        assert all(0 <= r["_s"] <= 1 for r in found)
        right = [int(r["_s"] >= threshold) == rows[r["doc_id"]][place] for r in found if r["out"]]
        assert np.mean(right) > 0.95
        odd = score(awkward(spark), model, "_s")
        assert odd.count() == 13 and odd.filter("_s is null or _s < 0 or _s > 1").count() == 0
        assert odd.columns == [*docs.columns, "_s"]
        assert score(empty(spark), model, "_s").count() == 0


def test_without_labels_everything_is_accepted(spark):
    docs, labels = awkward(spark), table(spark, [])
    model = quality.fit_quality(docs, labels, F.lit(True))
    assert {r["s"] for r in quality.with_quality(docs, model, "s").collect()} == {1.0}
    model = toxicity.fit_toxicity(docs, labels, F.lit(True))
    assert {r["s"] for r in toxicity.with_toxicity(docs, model, "s").collect()} == {0.0}
    one_kind = table(spark, [(9, 1, 0, ""), (10, 1, 0, "")])
    assert toxicity.fit_toxicity(docs, one_kind, F.lit(True)).trees is None
    model = quality.fit_quality(docs, one_kind, F.lit(True))
    assert all(r["s"] > 0.7 for r in quality.with_quality(docs, model, "s").collect())


def test_isotonic_pools_violators():
    at, value = quality.isotonic(np.arange(5.0), np.array([0.0, 0.6, 0.4, 0.4, 1.0]), np.array([1.0, 1, 1, 2, 1]))
    assert np.allclose(value, [0, 0.45, 1]) and np.allclose(at, [0, 2.25, 4])


def test_toxic_features():
    learned = toxicity.Terms(frozenset({"grumble"}), frozenset({"grum"}))
    found = toxicity.features("You IDIOT! l0ser s t u p i d sooo grumble grumbles", learned)
    assert found[2] == np.log1p(1) and found[4] == np.log1p(1) and found[6] == np.log1p(2)  # insult, word, stems
    assert found[8] == 1  # an insult next to the reader
    assert found[13] == 2  # two disguised insults
    assert not toxicity.features(None, learned).any()


def test_terms_of_copied_texts_count_once(spark):
    texts = [(prose(1, 30) + " copiedword", 1.0)] * 30 + [(prose(100 + i, 30) + f" rude rudely{i}", 1.0) for i in range(20)]
    texts += [(prose(500 + i, 30), 0.0) for i in range(200)]
    terms = toxicity.learn_terms(spark.createDataFrame(texts, "text string, y double"))
    assert "rude" in terms.words and "rude" in terms.stems and "copiedword" not in terms.words


def test_languages(spark):
    english, german = "the cat and the dog were in the house with their friends ", "der hund und die katze waren im haus mit ihren freunden "
    texts = [english * (1 + i % 4) if i % 2 else german * (1 + i % 4) for i in range(40)]
    docs = frame(spark, texts, {i: "en" if i % 2 else "de" for i in range(40)})
    profiles = language_id.learn_profiles(docs.filter("doc_id < 30"))
    assert profiles.groupBy("lang").agg(F.max("place")).filter(f"`max(place)` > {language_id.PROFILE}").count() == 0
    found = language_id.identify_languages(docs.select("doc_id", "lang", "text"), profiles).collect()
    assert all(r["lang"] == r["lang_pred"] and 0 <= r["score"] <= 1 for r in found)
    odd = {r["doc_id"]: r for r in language_id.identify_languages(awkward(spark).select("doc_id", "text"), profiles).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and odd[0]["score"] == 0
    none = language_id.learn_profiles(empty(spark))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs.select("doc_id", "text"), none).collect()} == {"und"}
    assert language_id.identify_languages(empty(spark).select("doc_id", "text"), profiles).count() == 0


def test_out_of_place_distance_by_hand():
    codes, counts = language_id.gram_counts("aa b1")
    text = {tuple(int(c) >> 21 * k & 0x1FFFFF for k in (2, 1, 0) if int(c) >> 21 * k): int(n) for c, n in zip(codes, counts)}
    a, b, s = ord("a"), ord("b"), 32
    assert text == {(a,): 2, (b,): 1, (s, a): 1, (a, a): 1, (a, s): 1, (s, b): 1, (b, s): 1, (s, a, a): 1, (a, a, s): 1, (s, b, s): 1}
    model = language_id.Profiles([("x", 1, a), ("x", 2, b), ("y", 1, b)], 300)
    # own order: a, then all counted once by code; b is second
    assert model.predict("aa b")[0] == "x"
