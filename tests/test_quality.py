"""Each kind of rule passing and failing, and the gate."""

import pytest
from pyspark.sql import functions as F

from hourstar.operators import quality
from hourstar.operators.quality import Rule, SchemaRule


@pytest.fixture
def dates(spark):
    rows = [("20240101", "Mon", 1), ("20240102", "Tue", 4), ("2024013", "Xyz", 5), (None, None, 1), ("20240101", "Mon", 2)]
    return spark.createDataFrame(rows, "date_key STRING, day_of_week STRING, quarter INT")


@pytest.mark.parametrize("rule,actual,passed", [
    (Rule("row_count", None, "=", 5), "5", True),
    (Rule("row_count", None, "=", 6), "5", False),
    (Rule("missing_count", "quarter"), "0", True),
    (Rule("missing_count", "date_key"), "1", False),
    (Rule("duplicate_count", "date_key"), "1", False),
    (Rule("duplicate_count", "date_key", "<=", 1), "1", True),
    (Rule("min", "quarter", ">=", 1), "1", True),
    (Rule("min", "quarter", "=", 2), "1", False),
    (Rule("max", "quarter", "<=", 4), "5", False),
    (Rule("max", "quarter", "<=", 5), "5", True),
    (Rule("min_length", "date_key", "=", 8), "7", False),
    (Rule("max_length", "date_key", "=", 8), "8", True),
    (Rule("invalid_count", "day_of_week", valid=quality.DAYS_OF_WEEK), "1", False),
    (Rule("invalid_count", "day_of_week", valid=(*quality.DAYS_OF_WEEK, "Xyz")), "0", True),
    (Rule("missing_count", "nowhere"), "no such column", False),
])
def test_rule(dates, rule, actual, passed):
    [row] = quality.evaluate("dim_date", dates, [rule]).collect()
    assert (row.table, row.check, row.column) == ("dim_date", rule.metric, rule.column)
    assert (row.actual, row.passed) == (actual, passed)


def test_schema_rules(dates):
    good, bad = SchemaRule((("quarter", "int"),)), SchemaRule((("quarter", "bigint"), ("absent", "int")))
    assert [r.passed for r in quality.evaluate("d", dates, [good]).collect()] == [True, True]
    assert [(r.check, r.actual, r.passed) for r in quality.evaluate("d", dates, [bad]).collect()] == [
        ("required_columns", "missing: absent", False), ("column_types", "quarter: int", False)]
    decimals = dates.selectExpr("cast(quarter as decimal(10,1)) as q")
    assert quality.evaluate("d", decimals, [SchemaRule((("q", "decimal"),))]).filter("not passed").isEmpty()


def test_metrics_over_no_rows_fail_except_counts(dates):
    none = dates.filter("false")
    rules = [Rule("min", "quarter", ">=", 1), Rule("missing_count", "quarter"), Rule("duplicate_count", "quarter")]
    assert sorted((r.check, r.passed) for r in quality.evaluate("d", none, rules).collect()) == [
        ("duplicate_count", True), ("min", False), ("missing_count", True)]


def test_unknown_metric_or_comparison(dates):
    with pytest.raises(ValueError):
        quality.evaluate("d", dates, [Rule("median", "quarter")])
    with pytest.raises(ValueError):
        quality.evaluate("d", dates, [Rule("max", "quarter", "<>", 1)])


def test_text_bounds_are_quoted(dates):
    [row] = quality.evaluate("d", dates, [Rule("max", "day_of_week", "<=", "it's \\ \"x\"")]).collect()
    assert (row.expected, row.actual, row.passed) == ("<= it's \\ \"x\"", "Xyz", True)


def test_gate_names_what_failed(dates):
    results = quality.scan({"d": dates}, {"d": [Rule("max", "quarter", "<=", 4), Rule("min", "quarter", ">=", 1)]})
    with pytest.raises(quality.QualityError, match=r"1 failed: d.quarter max <= 4, found 5"):
        quality.gate(results)
    quality.gate(results.filter("passed"))


def test_star_rules_are_sixty_checks():
    rules = quality.star_rules(77)
    assert {t: len(r) for t, r in rules.items()} == {
        "dim_province": 10, "dim_date": 24, "dim_time": 9, "fact_air_quality": 17}
    kinds = [r.metric if isinstance(r, Rule) else "schema" for rs in rules.values() for r in rs]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "schema": 4, "row_count": 1, "missing_count": 22, "duplicate_count": 7, "min": 8, "max": 7,
        "min_length": 5, "max_length": 5, "invalid_count": 1}


def test_orphans_and_missing_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (9,), (None,)], "fk INT")
    parent = spark.createDataFrame([(1,), (2,), (3,)], "pk INT")
    assert [(r.fk, r.n_rows) for r in quality.fk_orphans(child, "fk", parent, "pk").collect()] == [(9, 3)]
    [verdict] = quality.foreign_key_verdict("c", child, "fk", parent, "pk").collect()
    assert (verdict.actual, verdict.passed) == ("3", False)
    found = child.withColumnRenamed("fk", "pk")
    assert [r.pk for r in quality.missing_keys(parent, found, "pk").collect()] == [3]
    assert tuple(quality.completeness(parent, found, "pk").first()) == (3, 2, 1)


def test_foreign_keys_compare_values_of_unlike_types(spark):
    child = spark.createDataFrame([(1.0, "1", -0.0), (2.0, "x", 5.0), (None, None, None), (2.5, "2", 0.0)], "a double, b string, c double")
    child = child.withColumn("d", F.col("a").cast("decimal(9,3)"))
    parent = spark.createDataFrame([(1, 0), (2, 0)], "k int, z int")
    keys = {"a": (parent, "k"), "b": (parent, "k"), "c": (parent, "z"), "d": (parent, "k")}
    found = {r.column: r.actual for r in quality.foreign_key_verdicts("t", child, keys).collect()}
    assert found == {"a": "1", "b": "1", "c": "1", "d": "1"}


def test_metrics_taken_at_the_write_equal_those_of_a_scan(spark, dates, tmp_path):
    from hourstar.sources.tables import write_table

    rules = [
        SchemaRule((("quarter", "int"),)), Rule("row_count", None, "=", 5), Rule("missing_count", "date_key"),
        Rule("duplicate_count", "date_key"), Rule("min", "quarter", ">=", 1), Rule("max", "quarter", "<=", 4),
        Rule("min", "date_key", ">=", "20240101"), Rule("max_length", "date_key", "=", 8),
        Rule("invalid_count", "day_of_week", valid=quality.DAYS_OF_WEEK), Rule("max", "nowhere"),
    ]
    for k, (df, compact) in enumerate([(dates, False), (dates, True), (dates.repartition(7), False), (dates.filter("false"), True)]):
        measured, path = quality.Measured(rules), str(tmp_path / str(k))
        write_table(df, path, compact=compact, observe=measured.observe)
        back = spark.read.schema(dates.schema).parquet(path)
        found = quality.evaluate("d", back, rules, measured)
        wanted = quality.evaluate("d", back, rules)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))


def test_measured_rules_need_no_scan(spark, dates, tmp_path):
    from hourstar.sources.tables import write_table

    rules = [Rule("row_count", None, "=", 5), Rule("min", "quarter", ">=", 1), Rule("missing_count", "day_of_week")]
    measured = quality.Measured(rules)
    write_table(dates, str(tmp_path / "t"), observe=measured.observe)
    back = spark.read.parquet(str(tmp_path / "t"))

    def scans(verdicts):
        return verdicts._jdf.queryExecution().executedPlan().toString().count("FileScan")

    assert scans(quality.evaluate("t", back, rules)) == 1
    assert scans(quality.evaluate("t", back, rules, measured)) == 0
    both = [*rules, Rule("duplicate_count", "date_key")]
    assert scans(quality.evaluate("t", back, both)) == 2 and scans(quality.evaluate("t", back, both, measured)) == 1


def test_measured_rules_are_checked(dates):
    with pytest.raises(ValueError):
        quality.Measured([Rule("median", "quarter")]).observe(dates)
    with pytest.raises(ValueError):
        quality.Measured([Rule("max", "quarter", "<>", 1)]).observe(dates)
    assert quality.Measured([Rule("max", "nowhere")]).rows("d") == {}
