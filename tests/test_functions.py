import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimloom.errors import ContractError
from claimloom.functions import hashing, numbers, typing as t


def one(spark, *columns, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(*columns).first()
    return tuple(row)


def test_typed_measures_round_and_reject(spark):
    df = spark.createDataFrame([("12.5",), (" 7 ",), ("*",), ("",), (None,), ("bad",)], "x string")
    got = [tuple(r) for r in df.select(t.measure(F.col("x"), t.WHOLE), t.unparseable(F.col("x"), t.WHOLE, ("",)),
                                       t.fractional(F.col("x"))).collect()]
    assert got == [(13, False, True), (7, False, False), (None, True, False), (None, False, False),
                   (None, False, False), (None, True, False)]


def test_rounding_half_up_and_half_even(spark):
    value = F.lit("2.345").cast("decimal(18,3)")
    assert one(spark, F.round(value, 2), F.bround(value, 2), x=1) == (Decimal("2.35"), Decimal("2.34"))


def test_ratio_over_zero_is_null(spark):
    amount, nothing = F.lit("5.00").cast("decimal(18,2)"), F.lit(0).cast("decimal(14,0)")
    assert one(spark, numbers.rate(amount, nothing), x=1) == (None,)


def test_bands_and_statuses(spark):
    df = spark.createDataFrame([(10,), (11,), (13,), (36,), (None,)], "v int")
    ranges = (("low", 11, 13), ("top", 36, None))
    plain = [r[0] for r in df.select(t.band(F.col("v"), ranges)).collect()]
    hidden = [r[0] for r in df.select(t.band(F.col("v"), ranges, "suppressed")).collect()]
    assert plain == [None, "low", "low", "top", None]
    assert hidden == [None, "low", "low", "top", "suppressed"]


def test_relationship_flags_three_valued_or_false(spark):
    df = spark.createDataFrame([(2, 1), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(t.above(F.col("a"), F.col("b"), True)).collect()] == [True, False]
    assert [r[0] for r in df.select(t.above(F.col("a"), F.col("b"), False)).collect()] == [True, None]


def test_patterns_match_whole_text(spark):
    df = spark.createDataFrame([("123",), ("1234",), ("a123",)], "v string")
    assert [r[0] for r in df.select(t.matches(F.col("v"), "[0-9]{3}")).collect()] == [True, False, False]


def test_unit_fraction_is_the_first_eight_digest_bytes(spark):
    expected = int.from_bytes(hashlib.sha256(b"5:area:42").digest()[:8], "big") / 2**64
    assert one(spark, hashing.unit(5, "area", F.lit(42)), x=1)[0] == pytest.approx(expected, rel=1e-15)


def test_weights_must_sum_to_one():
    with pytest.raises(ContractError):
        hashing.weighted_choice(F.lit(0.5), [("a", 0.5), ("b", 0.4)])
    with pytest.raises(ContractError):
        hashing.normalized_weights([("a", 0.0)])


def test_fingerprint_ignores_order_and_sees_changes(spark):
    rows = [(1, "a"), (2, None), (2, None)]
    mark = lambda data: hashing.content_fingerprint(spark.createDataFrame(data, "i int, s string")).first()["content_sha256"]
    assert mark(rows) == mark(rows[::-1])
    assert mark(rows) != mark(rows[:2])
    assert mark(rows) != mark([(1, "a"), (2, None), (3, None)])
    assert mark([(None, "1")]) != mark([(1, None)])


def test_json_of_ordinary_and_awkward_values(spark):
    texts = ["plain", "", None, 'a"b', "a\\b", "tab\t", "line\n", "é", "\x7f", "{}", "end\n"]
    rows = [(t, i, None if i % 3 == 0 else Decimal(i - 4) / 100, date(2000, 1, 1 + i), i % 2 == 0) for i, t in enumerate(texts)]
    rows.append(("x", -5, Decimal("0.00"), None, None))
    df = spark.createDataFrame(rows, "s string, i int, m decimal(18,2), d date, b boolean").withColumns(
        {"far": F.expr("date_add(d, 3000000)"), "r": F.col("i") / 3, "tiny": F.col("m").cast("decimal(18,8)")})
    for name, kind in df.dtypes:
        plain = F.coalesce(F.to_json(F.struct(F.col(name).alias("v"))), F.lit("{}"))
        assert df.filter(~hashing.json_of(name, kind).eqNullSafe(plain)).count() == 0, name
    plan = spark.range(1).select(hashing.json_of("id", "bigint"))._jdf.queryExecution().analyzed().toString()
    assert "to_json" not in plan


def test_fingerprint_of_known_rows(spark):
    rows = [(1, "a"), (2, None), (2, None)]
    digests = [hashlib.sha256(text.encode()).hexdigest() for text in ('{"v":1},{"v":"a"}', '{"v":2},{}', '{"v":2},{}')]
    words = [str(sum(int(d[s : s + 15], 16) for d in digests)) for s in (0, 15, 30, 45)]
    expected = hashlib.sha256(":".join(["3", *words]).encode()).hexdigest()
    assert hashing.content_fingerprint(spark.createDataFrame(rows, "i int, s string")).first()["content_sha256"] == expected
    nothing = hashing.content_fingerprint(spark.createDataFrame([], "i int, s string")).first()
    assert nothing["content_sha256"] == hashlib.sha256(b"0:0:0:0:0").hexdigest()
