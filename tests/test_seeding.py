from pyspark.sql import functions as F

from claimloom.functions.hashing import select_ranked
from claimloom.plans import seeding


def test_lowest_eligible_equals_ranking_all_and_asks_about_few(spark):
    """Targets used to be ranked after all records were joined; now only the records with low digests are."""
    pool = spark.range(4_000).select(F.concat(F.lit("CLM"), F.col("id").cast("string")).alias("claim_id"), "id")
    twice = pool.union(pool.filter("id % 9 = 0")).union(spark.sql("SELECT CAST(NULL AS STRING), -1L"))
    for step, most in ((2, 160), (100, 4_500), (1_001, 4_500)):
        asked = []

        def eligible(some, step=step):
            asked.append(some.count())
            return some.filter(F.col("id") % step == 0)

        ranked = (5, "test", "claim_id")
        found = seeding.lowest_eligible(twice, 4_000, eligible, *ranked, 5)
        pick = lambda df: [tuple(r) for r in select_ranked(df, *ranked, 5, ("X",)).collect()]
        assert sorted(pick(found)) == sorted(pick(eligible(twice)))
        assert 0 < asked[0] < 160 and max(asked[:-1]) <= most


def test_small_table_or_wrong_size_finds_all(spark):
    pool = spark.range(30).withColumn("claim_id", F.col("id").cast("string"))
    for rows in (0, 30, 10_000_000):
        assert seeding.lowest_eligible(pool, rows, lambda some: some, 5, "test", "claim_id", 40).count() == 30


def test_numbers_follow_inserted_rows_and_the_table_is_looked_through_once(spark):
    rows = spark.sql("SELECT * FROM VALUES ('LIN0007'), ('LIN0012'), (NULL) t(claim_line_id)")
    looked, seen = [], {}

    def keep(name, build):
        if name not in seen:
            looked.append(name)
            seen[name] = build()
        return seen[name]

    state = seeding.Seeded({"claim_line": rows}, keep=keep)
    assert state.numbers("claim_line", "claim_line_id") == ("LIN", 12, 4)
    new = spark.sql("SELECT 'LIN10013' AS claim_line_id")
    labels = spark.sql("SELECT 'a' AS claim_id")
    after = state.extended({"claim_line": rows.unionByName(new)}, labels, labels, {"claim_line": new})
    assert after.numbers("claim_line", "claim_line_id") == ("LIN", 10_013, 5)
    assert len(looked) == 1
