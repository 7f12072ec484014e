import random

import pytest
from pyspark.sql import functions as F

from claimloom.operators import keys
from claimloom.operators import percentiles
from claimloom.session import ensure_checkpoint_dir


def test_checkpoint_dir_is_taken_from_the_session(spark):
    ensure_checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert configured in spark.sparkContext.getCheckpointDir()


def test_dense_keys_follow_sorted_order(spark):
    df = spark.range(3000).select(F.concat(F.lit("K"), F.lpad((F.col("id") * 7919 % 3000).cast("string"), 5, "0")).alias("k"))
    found = {r["k"]: r["n"] for r in keys.dense_keys(df.unionAll(df.limit(500)), ["k"], "n").collect()}
    assert found == {k: i for i, k in enumerate(sorted(found), start=1)}
    assert keys.dense_keys(spark.createDataFrame([("b",), (None,), ("a",)], "k string"), ["k"], "n").count() == 3


def plain_numbers(rows):
    seen = {}
    out = []
    for g, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen[g] = seen.get(g, 0) + 1
        out.append((g, v, seen[g]))
    return sorted(out, key=str)


@pytest.mark.parametrize("groups", [1, 1_500, 7])
def test_number_within_keys_of_any_size(spark, groups):
    # a third of all rows in one key, some in none, the others spread
    rows = [(None if i % 50 == 1 else 0 if i % 3 == 0 else i % groups + 1, i) for i in range(6_000)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(5)
    found = keys.number_within(df, ["g"], ["v"], "n")
    assert found.columns == ["g", "v", "n"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_numbers(rows)


def test_layers_are_told_apart_by_settings_and_input(spark, tmp_path):
    from claimloom.sources.layers import LayerStore

    spark.range(2).write.parquet(str(tmp_path / "in" / "t.parquet"))
    store = LayerStore(spark, str(tmp_path / "in"))
    first = store.keep("panel", lambda: spark.range(3), ("policy", 2000))
    second = store.keep("panel", lambda: spark.range(5), ("policy", 1999))
    again = store.keep("panel", lambda: spark.range(9), ("policy", 2000))
    assert (first.count(), second.count(), again.count()) == (3, 5, 3)
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "in" / "t.parquet"))
    assert LayerStore(spark, str(tmp_path / "in")).root != store.root


def test_tables_are_built_when_asked_for(spark, monkeypatch):
    from claimloom.sources.warehouse_model import WarehouseModel
    from tests.conftest import SMALL

    model = WarehouseModel(spark, SMALL)
    monkeypatch.setattr(model.layers, "keep", lambda *_, **__: pytest.fail("a layer was written"))
    assert model.tables()["plan"].count() > 0 and "claim_line" in model.tables()
    with pytest.raises(KeyError):
        model.tables()["nothing"]


def test_dense_positions_of_empty_table(spark):
    empty = spark.createDataFrame([], "a string")
    assert keys.dense_positions(empty, ["a"]).count() == 0


def test_exact_percentiles_match_interpolation(spark, monkeypatch):
    rows = [("a", float(v)) for v in (5, 1, 1, 9, 2.5)] + [("b", 3.0), ("b", None), ("c", -4.0), ("c", 4.0), ("d", float("nan"))]
    rows += [(None, 1.0), (None, 2.0), ("e", -1e308), ("e", 1e308), ("e", 0.0), ("f", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["m"], r["p"]) for r in percentiles.exact_percentiles(df, ["g"], "v", {"m": 0.5, "p": 0.9}).collect()}
    assert got == {
        "a": (2.5, pytest.approx(7.4)), "b": (3.0, 3.0), "c": (pytest.approx(0.0), pytest.approx(3.2)),
        None: (1.5, pytest.approx(1.9)), "e": (0.0, pytest.approx(8e307)),
    }


@pytest.mark.parametrize("bins", [64, 8192])
def test_ranks_of_skewed_values_in_any_number_of_bins(spark, monkeypatch, bins):
    monkeypatch.setattr(percentiles, "BINS", bins)
    draw = random.Random(bins)
    values = {
        "money": [round(draw.expovariate(0.001), 2) for _ in range(400)], "few": [draw.choice([1.0, 2.0, 7.0]) for _ in range(90)],
        "wide": [draw.choice([-1, 1]) * 10.0 ** draw.randrange(-2, 6) for _ in range(120)], "one": [4.25] * 50,
    }
    rows = [(key, value) for key, group in values.items() for value in group]
    counts = spark.createDataFrame(rows, "key string, value double").groupBy("key", "value").count().withColumnRenamed("count", "n")
    ranks = [(key, rank) for key, group in values.items() for rank in (0, len(group) // 3, len(group) // 2, len(group) - 1, len(group))]
    found = percentiles.values_at_ranks(counts, spark.createDataFrame(ranks, "key string, rank long")).collect()
    assert {(r["key"], r["rank"]): r["value"] for r in found} == {
        (key, rank): sorted(values[key])[rank] for key, rank in ranks if rank < len(values[key])}


def test_percentiles_of_empty_table(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert percentiles.exact_percentiles(empty, ["g"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("most", [300, 3_000])
def test_crowded_keys_are_numbered_over_many_tasks(spark, monkeypatch, most):
    rows = [(None if i % 5 == 1 else 0 if i % 3 == 0 else i % 900 + 1, i) for i in range(6_000)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(5)
    monkeypatch.setattr(keys, "CROWDED", most)
    found = keys.number_within(df, ["g"], ["v"], "n")
    assert found.columns == ["g", "v", "n"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_numbers(rows)


def test_ordinary_keys_are_numbered_without_a_written_copy(spark, monkeypatch):
    monkeypatch.setattr(keys, "dense_positions", lambda *_: pytest.fail("the table was sorted as a whole and written"))
    df = spark.range(100).selectExpr("id % 7 AS g", "id AS v")
    assert keys.number_within(df, ["g"], ["v"], "n").agg(F.max("n")).first()[0] == 15


def test_written_tables_are_sized_by_their_rows(spark):
    from claimloom.session import written

    many = written(spark.range(1_500_000).select(F.concat(F.lit("CLM"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("k"), F.lit(1).alias("one")))
    few = spark.range(4_000_000).select(F.concat(F.lit("CLM"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("k"))
    plan = few.join(many, "k")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_ranks_are_found_without_rounds(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "BINS", 16)
    calls = []
    kept = percentiles.written
    monkeypatch.setattr(percentiles, "written", lambda df: calls.append(1) or kept(df))
    counts = spark.range(1, 1_200).selectExpr("id % 3 AS key", "pow(1.2, id) AS value", "1L AS n")
    found = percentiles.values_at_ranks(counts, spark.range(3).selectExpr("id AS key", "200L AS rank")).collect()
    assert {r["key"]: r["value"] for r in found} == {g: pytest.approx(1.2 ** ((g or 3) + 600)) for g in range(3)}
    assert len(calls) == 2


def test_members_are_dealt_to_all_tasks_before_their_months(spark):
    from claimloom.sources.warehouse_model import WarehouseModel
    from tests.conftest import SMALL

    assert WarehouseModel(spark, SMALL)._membership_month.rdd.getNumPartitions() == 8
