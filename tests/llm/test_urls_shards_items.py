import re
import zlib

import numpy as np
import pytest

from claimloom.llm import decontamination, sharding, url_filter
from claimloom.llm.queries import RULES
from tests.llm.helpers import awkward, empty, frame, prose

PAGES = "page_id long, url string, host string, rule string, verdict int"


def judged(spark, urls):
    pages = spark.createDataFrame([(i, u, "h", "r", 0) for i, u in enumerate(urls)], PAGES).repartition(3)
    return {r["page_id"]: r for r in url_filter.judge_urls(pages, RULES).collect()}


def plain_rule(url):
    start = (url or "").find("://")
    if start < 0:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url[start + 3 :]).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in RULES:
        name, _, rest = rule.text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best


def test_rules_and_parts_of_urls(spark):
    urls = [
        None, "", "no scheme/com/", "http://", "http://com", "http://com/", "HTTP://A.COM/x", "https://WWW.Example.com/en/1?x#y", "http://example.com/en/",
        "http://notexample.com/en/", "http://ex.net/es", "http://ex.net/es/1", "http://ex.net#es/", "http://u:p@ex.net:80/fr/", "a://b://c/d", "http://É.net/fr/é?",
        "http://x.org/ünï\n/2", "http://x.org//a//b/", "http://x.org/" + "deep/" * 40 + "end", "http://x.org/0123456789abcdef0/1", "http://ex.net/es/1",
    ]
    found = judged(spark, urls)
    assert len(found) == len(urls)
    for at, url in enumerate(urls):
        host, path, rule = plain_rule(url)
        row = found[at]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule and rule.text)
        assert row["verdict"] == rule.verdict if rule else row["verdict"] in ("allow", "block")
    assert judged(spark, []) == {}


def test_tree_has_no_greatest_depth(spark):
    base = "http://deep.org/" + "/".join("abcdefghijk")  # eleven segments, then branches
    urls = [f"{base}/w{chr(97 + i)}{chr(97 + i)}/story" for i in range(20)]
    urls += ["http://one.org/" + "x/" * 300 + end for end in ("left/a", "right/b/c")]
    found = judged(spark, urls)
    assert {found[i]["template"] for i in range(20)} == {"/a/b/c/d/e/f/g/h/i/j/k/*/story"}
    # two urls are too few to tell branches apart, at level 300 as at level 0
    assert [found[i]["template"] for i in (20, 21)] == ["/" + "x/" * 300 + "*/*", "/" + "x/" * 300 + "*/*/c"]


def test_signs_of_a_path_are_not_those_of_the_tree(spark):
    paths = spark.createDataFrame([(p,) for p in ("/*/a", "/<n>/a", "/7/a", "/b\\c", "/$")], "path string")
    shapes = [r[0] for r in paths.select(url_filter.path_shape(paths["path"])).collect()]
    assert shapes == ["/\\*/a", "/\\<n>/a", "/<n>/a", "/b\\\\c", "/$"]


def test_templates_learn_from_rules(spark):
    urls = [f"http://shop.net/es/{i}/x-{i * 7}.html" for i in range(60)]  # blocked by a rule
    urls += [f"http://shop.net/en/{i}/x-{i * 7}.html" for i in range(60)]  # no rule
    urls += [f"http://news.org/{word}/story" for word in "abcdefghijklmnopqrstuvwxyz"]
    urls += [f"http://mixed.net/{'es' if i % 4 else 'xx'}/p" for i in range(40)]
    found = judged(spark, urls)
    # branches with and without labels stay apart, words that vary freely become one template
    assert {found[i]["template"] for i in range(60)} == {"/es/<n>/x-<n>.html"}
    assert {(found[i]["template"], found[i]["verdict"]) for i in range(60, 120)} == {("/en/<n>/x-<n>.html", "allow")}
    assert {(found[i]["template"], found[i]["verdict"]) for i in range(120, 146)} == {("/*/story", "allow")}
    assert {found[i]["verdict"] for i in range(146, 186) if "/xx/" in urls[i]} == {"allow"}


def test_rejected_templates_block_where_no_rule_fits(spark):
    # too few urls to tell the branches apart: they share a template, whose labelled urls are all blocked
    urls = [f"http://few.net/{name}/{i}" for i, name in enumerate(["es", "fr", "es", "fr", "en"])]
    found = judged(spark, urls)
    assert {found[i]["template"] for i in range(5)} == {"/*/<n>"}
    assert found[4]["rule"] is None and found[4]["verdict"] == "block"


def test_shards_are_even_whole_and_gapless(spark):
    draw = np.random.default_rng(2)
    texts = [prose(i, int(draw.integers(1, 200))) for i in range(1500)]
    texts += [texts[0]] * 100 + [texts[1]] * 40 + [None, "", "é" * 50]
    found = sharding.shard_documents(frame(spark, texts)).toPandas()
    assert sorted(found["doc_id"]) == list(range(len(texts)))
    for row in found.itertuples():
        raw = (texts[row.doc_id] or "").encode()
        assert row.size == len(raw) + 1 and row.text_crc32 == zlib.crc32(raw)
    sums = found.groupby("shard")["size"].sum()
    assert sorted(sums.index) == list(range(8)) and sums.max() / sums.min() < 1.06
    assert (found.groupby(["text_crc32", "size"])["shard"].nunique() == 1).all()
    for _, shard in found.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    assert set(found["law"]) == {"bytes"} and found["grown_shard"].isna().all()


def test_a_group_beyond_a_shard_is_divided(spark):
    texts = ["the same text again and again"] * 4000 + [prose(i, 30) for i in range(300)]
    found = sharding.shard_documents(frame(spark, texts)).toPandas()
    sums = found.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() / sums.min() < 1.3


@pytest.mark.parametrize("shards", [1, 3])
def test_awkward_and_empty_documents_shard(spark, shards):
    found = sharding.shard_documents(awkward(spark), shards).toPandas()
    assert len(found) == 13 and found["shard"].between(0, shards - 1).all() and found["doc_id"].isna().sum() == 1
    for _, shard in found.groupby("shard"):
        assert sorted(shard["slot"]) == list(range(len(shard)))
    assert sharding.shard_documents(empty(spark), shards).count() == 0


def items(spark, texts):
    return spark.createDataFrame([(i, t, 0.0) for i, t in enumerate(texts)], "item_id long, text string, score double")


def test_planted_items_are_found_and_others_left(spark):
    tests = [f"Which {prose(900 + i, 15)}? The answer is {prose(700 + i, 6)}." for i in range(30)] + [None, "", "?!", "tiny"]
    texts = [prose(i, 300) for i in range(40)]
    for i in range(10):
        words = texts[i].split()
        texts[i] = " ".join([*words[: 29 * i], tests[i].upper() if i % 2 else tests[i], *words[29 * i :]])
    texts[20] += " " + " ".join(tests[20].split()[:8])  # a part of a question only
    docs = frame(spark, texts)
    found = decontamination.contaminated(docs, items(spark, tests)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, i) for i in range(10)]
    kept = decontamination.without_contaminated(docs, items(spark, tests))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(10, 40))


def test_retrieval_equals_plain_scoring(monkeypatch):
    monkeypatch.setattr(decontamination, "THRESHOLD", 0.2)
    index = decontamination.ItemIndex([(i, prose(i, 12)) for i in range(100)])
    lists = index.postings
    for n in range(50):
        terms = np.array(sorted({index.terms[w] for w in decontamination.WORD.findall(prose(n + 7, 40)) if w in index.terms}), dtype=np.int64)
        scores = dict.fromkeys(range(100), 0.0)
        for term in terms:
            for at in range(lists.starts[term], lists.starts[term + 1]):
                scores[int(lists.places[at])] += lists.weights[at]
        assert {i for i, _ in index.retrieve(terms)} == {i for i, s in scores.items() if s >= 0.2 - decontamination.ROUNDING}
    own = np.array(sorted({index.terms[w] for w in decontamination.WORD.findall(prose(3, 12))}), dtype=np.int64)
    assert np.isclose(dict(index.retrieve(own))[3], 1.0)


def test_several_indexes_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "INDEX_BYTES", 300)
    tests = [prose(900 + i, 20) + "." for i in range(20)]
    docs = frame(spark, [tests[i % 20] for i in range(40)])
    assert sorted((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, items(spark, tests)).collect()) == [(i, i % 20) for i in range(40)]
    assert decontamination.without_contaminated(docs, items(spark, tests)).count() == 0
    assert decontamination.contaminated(empty(spark), items(spark, tests)).count() == 0
    assert decontamination.contaminated(docs, items(spark, []).limit(0)).count() == 0
    assert decontamination.contaminated(awkward(spark), items(spark, [prose(2, 40)])).count() == 2
