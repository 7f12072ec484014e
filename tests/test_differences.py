"""Row and field differences of two versions of a table."""

import pytest
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.operators import differences


def versions(spark):
    before = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), ("c", 3, "z"), ("d", None, None)], "id string, amount int, note string")
    after = spark.createDataFrame([("a", 1, "x"), ("b", 2, "new"), ("d", 4, ""), ("e", 5, None)], "id string, amount int, note string")
    return tuple(df.selectExpr("id", "cast(amount as decimal(18,2)) amount", "note") for df in (before, after))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rows_and_fields(spark):
    before, after = versions(spark)
    # another column order is no change
    found = differences.row_changes(before, after.select("note", "id", "amount"), "id")
    assert rows(found) == [("b", "update"), ("c", "delete"), ("d", "update"), ("e", "insert")]
    fields = {(r["record_id"], r["column_name"]): (r["operation"], r["before_value"], r["after_value"])
              for r in differences.field_changes(before, after, "id").collect()}
    assert fields == {
        ("b", "note"): ("update", None, "new"), ("d", "amount"): ("update", None, "4.00"), ("d", "note"): ("update", None, ""),
        ("c", "id"): ("delete", "c", None), ("c", "amount"): ("delete", "3.00", None), ("c", "note"): ("delete", "z", None),
        ("e", "id"): ("insert", None, "e"), ("e", "amount"): ("insert", None, "5.00"), ("e", "note"): ("insert", None, None),
    }


def test_equal_and_empty_versions(spark):
    before, after = versions(spark)
    assert differences.row_changes(before, before, "id").count() == 0
    none = after.filter("false")
    assert {r["operation"] for r in differences.row_changes(none, after, "id").collect()} == {"insert"}
    assert differences.row_changes(none, none, "id").count() == 0
    with pytest.raises(ContractError, match="note"):
        differences.row_changes(before, after.drop("note"), "id")


def test_log_is_held_against_what_changed(spark):
    before, after = versions(spark)
    found = differences.field_changes(before, after, "id").filter("operation = 'update'")
    log = spark.createDataFrame(
        [(1, "t", "b", "update", "note", None, "draft"), (2, "t", "b", "update", "note", "draft", "new"),
         (3, "t", "d", "update", "amount", None, "4.00"), (4, "t", "d", "update", "note", None, ""),
         # ends where it began
         (5, "t", "a", "update", "note", "x", "y"), (6, "t", "a", "update", "note", "y", "x")],
        "n int, target_table string, target_record_id string, field_operation string, column_name string, before_value string, after_value string",
    )
    assert differences.unlike_fields(found, differences.net_changes(log, ["n"])).count() == 0
    short = differences.net_changes(log.filter("n <> 3"), ["n"])
    assert [(r["record_id"], r["surplus"]) for r in differences.unlike_fields(found, short).collect()] == [("d", 1)]


def crowd(spark, rows):
    """Rows numbered 0 to ``rows`` with their number as text."""
    return spark.range(rows).selectExpr("cast(id as string) id", "cast(id as decimal(18,2)) amount", "if(id % 3 = 0, null, 'n') note")


def test_only_buckets_with_a_change_are_compared(spark):
    before = crowd(spark, 50_000)
    after = before.filter("id <> '7'").withColumn("note", F.when(F.col("id") == "11", "x").otherwise(F.col("note")))
    after = after.union(spark.createDataFrame([("new", None, None)], after.schema))
    expected = [("11", "update"), ("7", "delete"), ("new", "insert")]
    unlike = differences.unlike_buckets(before, after, "id")
    assert 1 <= unlike.count() <= 3
    changes = differences.row_changes(before, after, "id")
    assert rows(changes) == expected
    # rows of unlike buckets only reach the join: some three of 50,000 in each bucket
    plan = changes._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and rows(differences.row_changes(before, after, "id", unique=False)) == expected


def test_repeated_and_null_keys_are_compared_pair_by_pair(spark):
    one = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "id string, amount int")
    assert not differences.unique_key(one, "id") and not differences.unique_key(one.filter("amount > 2"), "id")
    assert differences.unique_key(one.filter("amount in (1, 4)"), "id")
    # each of a key's rows is held against each, a null key meets none
    expected = [(None, "delete"), (None, "insert"), ("a", "update"), ("a", "update")]
    found = [tuple(r) for r in differences.row_changes(one, one, "id").collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_keys_may_stop_being_unique(spark):
    before = crowd(spark, 100)
    more = before.union(before.filter("id = '5'").withColumn("note", F.lit("other")))
    empty = before.union(before.filter("id = '5'").withColumn("id", F.lit(None).cast("string")))
    for after, stays in ((before, True), (before.filter("id > '5'"), True), (more, False), (empty, False)):
        changed = differences.row_changes(before, after, "id", unique=True)
        assert differences.stays_unique(after, "id", changed) is stays


def test_unchanged_rows_do_not_travel_for_fields(spark):
    before = crowd(spark, 1_000)
    after = before.withColumn("amount", F.when(F.col("id") == "3", 5).otherwise(F.col("amount")).cast("decimal(18,2)"))
    changed = spark.createDataFrame([("3", "update")], "record_id string, operation string")
    found = differences.field_changes(before, after, "id", changed)
    assert rows(found) == [("3", "update", "amount", "3.00", "5.00")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2
