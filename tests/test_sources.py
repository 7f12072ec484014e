import pytest
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.sources import landing, publish


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_text_landing_keeps_tokens_and_adds_lineage(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'CODE,AMOUNT,NOTE\nA,10.25,"x, ""y"""\nB,*,\n')
    rows = landing.read_text_csv(spark, path, "src", 2020, {"CODE": "code_id"}).collect()
    assert [(r["code_id"], r["AMOUNT"], r["NOTE"]) for r in rows] == [("A", "10.25", 'x, "y"'), ("B", "*", None)]
    assert rows[0]["_source_id"] == "src" and rows[0]["_reporting_year"] == 2020 and rows[0]["_source_file"] == "a.csv"


def test_cp1252_reads_and_wrong_encoding_fails(spark, tmp_path):
    path = write(tmp_path / "c.csv", "NAME,V\nCafé – €,1\n", "cp1252")
    assert landing.read_text_csv(spark, path, "s", 2020, encoding="cp1252").first()["NAME"] == "Café – €"
    with pytest.raises(Exception, match="do not fit utf-8"):
        landing.read_text_csv(spark, path, "s", 2020).write.mode("overwrite").parquet(str(tmp_path / "out"))


def test_malformed_rows_fail_on_write(spark, tmp_path):
    path = write(tmp_path / "m.csv", "A,B\n1,2\n1,2,3\n")
    with pytest.raises(Exception, match="malformed row"):
        landing.read_text_csv(spark, path, "s", 2020).write.mode("overwrite").parquet(str(tmp_path / "out"))


def test_alias_collision_is_refused():
    assert landing.active_aliases(["A", "B"], {"A": "a", "Z": "z"}) == {"A": "a"}
    with pytest.raises(ContractError):
        landing.active_aliases(["A", "B"], {"A": "B"})


def test_family_landing_reports_drift(spark, tmp_path):
    root, out = tmp_path / "raw", tmp_path / "bronze"
    write(root / "fam" / "2019" / "x.csv", "A,B\n1,2\n3,4\n")
    write(root / "fam" / "2020" / "y.CSV", "A,B,C\n1,2,3\n")
    inventory = {r["reporting_year"]: r for r in
                 landing.land_family(spark, str(root), str(out), "fam", [2019, 2020]).collect()}
    assert (inventory[2019]["row_count"], inventory[2020]["source_column_count"]) == (2, 3)
    assert not inventory[2019]["schema_consistent"]
    whole = spark.read.parquet(f"{out}/fam")
    assert set(whole.select("_reporting_year").distinct().toPandas()["_reporting_year"]) == {2019, 2020}
    write(root / "fam" / "2020" / "second.csv", "A\n1\n")
    with pytest.raises(ContractError, match="found 2"):
        landing.discover_annual_files(spark, str(root), "fam", [2020])
    with pytest.raises(ContractError, match="missing folder"):
        landing.discover_annual_files(spark, str(root), "fam", [2021])


def test_publish_swaps_only_valid_tables(spark, tmp_path):
    path = str(tmp_path / "table")
    publish.publish(spark.range(3).toDF("id"), path)

    def refuse(written):
        raise ContractError("no")

    with pytest.raises(ContractError):
        publish.publish(spark.range(5).toDF("id"), path, refuse)
    assert publish.published(spark, path).count() == 3
    publish.publish(spark.range(5).toDF("id"), path)
    assert publish.published(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_published_table_is_whole_at_every_step(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "table"), []
    look = lambda *_: seen.append(publish.published(spark, path).count())
    publish.publish(spark.range(1).toDF("id"), path)
    reader = publish.published(spark, path)  # resolved before the next commit, read after it
    collect = publish.collect_versions

    def watched(*arguments):
        look()
        gone = collect(*arguments)
        look()
        return gone

    monkeypatch.setattr(publish, "collect_versions", watched)
    publish.publish(spark.range(2).toDF("id"), path, look)
    assert seen == [1, 2, 2] and reader.count() == 1
    publish.publish(spark.range(3).toDF("id"), path, look)
    assert seen == [1, 2, 2, 2, 3, 3]
    assert len(list((tmp_path / "table" / "_versions").iterdir())) == 2


def test_abandoned_versions_are_collected(spark, tmp_path):
    path = str(tmp_path / "table")
    publish.publish(spark.range(4).toDF("id"), path)
    # a writer lost before its commit: nothing changes for readers
    spark.range(9).write.parquet(f"{path}/_versions/{'0' * 32}")
    assert publish.published(spark, path).count() == 4
    assert publish.collect_versions(spark, path) == []
    assert publish.collect_versions(spark, path, abandoned_ms=-60_000) == ["0" * 32]
    assert publish.published(spark, path).count() == 4
    assert publish.current_version(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(ContractError):
        publish.collect_versions(spark, path, keep=0)


def test_load_tables_names_everything_missing(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "here"))
    assert set(publish.load_tables(spark, str(tmp_path), ["here"])) == {"here"}
    with pytest.raises(ContractError, match="a, b"):
        publish.load_tables(spark, str(tmp_path), ["a", "here", "b"])


def test_conform_casts_and_requires(spark):
    schema = publish.table_schema({"id": ("BIGINT", False), "amount": ("DECIMAL(18,2)", True)})
    df = spark.createDataFrame([("1", "2.5")], "id string, amount string")
    assert publish.conform(df, schema).schema.simpleString() == "struct<id:bigint,amount:decimal(18,2)>"
    with pytest.raises(Exception, match="null in id"):
        publish.conform(df.withColumn("id", F.lit(None).cast("string")), schema).collect()
    with pytest.raises(ContractError):
        publish.table_schema({"x": ("MAP", True)})


def test_csv_export_formats(spark, tmp_path):
    df = spark.createDataFrame([(2, 1.5, None, True), (1, 2.0, "b", False)], "i int, d double, s string, f boolean")
    publish.write_csv(df.coalesce(1), str(tmp_path / "csv"), ["i"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*.csv")))
    assert [line for line in text.split("\n") if line and not line.startswith("i,")] == ["1,2.0000,b,0", "2,1.5000,,1"]


def test_managed_table_overwrites_schema(spark):
    publish.save_managed(spark.range(2).toDF("a"), "domain_x", "t")
    loaded = publish.save_managed(spark.range(3).toDF("b"), "domain_x", "t")
    assert loaded.columns == ["b"] and loaded.count() == 3


def test_stable_sample_and_latest(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")], "key string, v int, x string")
    assert publish.stable_sample(df, ["key", "v"], 1).first()["x"] == "only"
    newest = {r["key"]: r["x"] for r in landing.latest_per_key(df, ["key"], F.col("v")).collect()}
    assert newest == {"k": "new", "j": "only"}


def written_csv(path, rows):
    import csv
    import io

    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return write(path, out.getvalue())


def test_quoted_line_breaks_are_part_of_a_record(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'id,note\n1,"x\ny,z"\n2,"a\r\n""b"""\n\n3,plain\r\n4,"\ufffd"\n5,""\n')
    rows = sorted(landing.read_text_csv(spark, path, "s", 2020).collect(), key=lambda r: r["id"])
    wanted = [("1", "x\ny,z"), ("2", 'a\r\n"b"'), ("3", "plain"), ("4", "\ufffd"), ("5", None)]
    assert [(r["id"], r["note"]) for r in rows] == wanted


@pytest.mark.parametrize("split_bytes", [50, 333, 100_000])
def test_splits_fall_anywhere(spark, tmp_path, split_bytes):
    import random

    draw = random.Random(split_bytes)
    rows = [(str(i), draw.choice(["", "a,b", "line\nbreak", '"', 'q"\n"\n\n,', "x" * 40, "é\n" * 30]), "t") for i in range(200)]
    path = written_csv(tmp_path / "s.csv", [("id", "note", "end"), *rows])
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in before:
            spark.conf.set(name, split_bytes)
        found = landing.read_text_csv(spark, path, "s", 2020).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sorted((int(r["id"]), r["note"] or "", r["end"]) for r in found) == [(int(i), n, t) for i, n, t in rows]


def test_open_quotes_other_headers_and_marks(spark, tmp_path):
    path = write(tmp_path / "o.csv", 'A,B\n1,"never closed\n2,3\n')
    with pytest.raises(Exception, match="malformed row"):
        landing.read_text_csv(spark, path, "s", 2020).collect()
    write(tmp_path / "two.csv" / "a.csv", "A,B\n1,2\n")
    write(tmp_path / "two.csv" / "b.csv", "A,C\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        landing.read_text_csv(spark, str(tmp_path / "two.csv"), "s", 2020).collect()
    path = write(tmp_path / "b.csv", "\ufeffA,B\n1,2\n")
    assert landing.read_text_csv(spark, path, "s", 2020, encoding="utf-8-sig").first()["A"] == "1"
    with pytest.raises(ContractError):
        landing.read_text_csv(spark, path, "s", 2020, encoding="utf-16")


def test_folder_of_parts_counts_as_one_annual_file(spark, tmp_path):
    spark.createDataFrame([("1", "a"), ("2", "b")], "A string, B string").repartition(2).write.csv(
        str(tmp_path / "fam" / "2020" / "fam.csv"), header=True)
    found = landing.discover_annual_files(spark, str(tmp_path), "fam", [2020])
    rows = landing.read_text_csv(spark, found[2020], "fam", 2020).collect()
    assert sorted(r["A"] for r in rows) == ["1", "2"]


def test_footers_tell_codec_row_groups_and_bounds(spark, tmp_path):
    rows = spark.range(250).select("id", F.when(F.col("id") % 5 != 0, F.col("id").cast("string")).alias("text")).coalesce(1)
    footers = publish.parquet_footers(publish.publish(rows, str(tmp_path / "groups"), row_group_rows=100)).collect()
    ids = sorted((r for r in footers if r["column_name"] == "id"), key=lambda r: r["row_group"])
    assert [r["row_count"] for r in ids] == [100, 100, 50] and {r["codec"] for r in footers} == {"ZSTD"}
    assert [(r["smallest"], r["largest"]) for r in ids] == [("0", "99"), ("100", "199"), ("200", "249")]
    assert sum(r["null_count"] for r in footers if r["column_name"] == "text") == 50
    empty = publish.publish(rows.filter("id < 0"), str(tmp_path / "none"))
    assert publish.parquet_footers(empty).agg(F.sum("row_count")).first()[0] is None


def test_load_with_a_lost_row_raises_when_strict(spark):
    from claimloom.plans import reporting

    tables = {"rule_finding": spark.createDataFrame([("F1", 10), ("F2", 5)], "finding_id string, amount_at_risk int")}
    keys, measures = {"rule_finding": ["finding_id"]}, {"rule_finding": ["amount_at_risk"]}
    manifest = reporting.table_manifest(tables, keys, measures)
    assert reporting.load_and_validate(tables, manifest, keys, measures, "load_whole").filter("not passed").count() == 0
    short = {"rule_finding": tables["rule_finding"].limit(1)}
    with pytest.raises(ContractError, match="rule_finding row_count"):
        reporting.load_and_validate(short, manifest, keys, measures, "load_short")


def test_versions_know_the_claim_before_without_another_shuffle(spark, tmp_path, monkeypatch):
    """Orders of a customer in a month are linked in order; none without customer or date; keys of many rows come to the same."""
    from claimloom.operators import keys
    from claimloom.sources.warehouse_model import WarehouseModel

    orders = [(1, 7, "1996-01-03"), (2, 7, "1996-01-02"), (3, 7, "1996-01-02"), (4, 7, "1996-02-01"), (5, 8, "1996-01-09"),
              (6, None, "1996-01-05"), (7, None, "1996-01-06"), (8, 9, None), (9, 9, None), (5, 8, "1996-01-09")]
    rows = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, day string").selectExpr(
        "o_orderkey", "o_custkey", "'F' o_orderstatus", "1.0d o_totalprice", "cast(day as timestamp_ntz) o_orderdate", "'5-LOW' o_orderpriority")
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    found = []
    for crowded in (keys.CROWDED, 1):
        monkeypatch.setattr(keys, "CROWDED", crowded)
        linked = WarehouseModel(spark, str(tmp_path))._linked_versions
        plan = linked._jdf.queryExecution().executedPlan().toString()
        found.append(sorted((r["o_orderkey"], r["claim_version_number"], r["prior_claim_id"]) for r in linked.collect()))
        if crowded > 1:
            assert plan.count("Exchange hashpartitioning") == 1
    name = lambda key: f"CLM{key:012d}"
    assert [row for row in found[0] if row[0] < 5] == [(1, 3, name(3)), (2, 1, None), (3, 2, name(2)), (4, 1, None)]
    assert [row[2] for row in found[0] if row[0] == 5] == [None, name(5)]
    assert all(row[2] is None for row in found[0] if row[0] > 5)
    assert found[0] == found[1]
