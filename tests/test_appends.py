"""Keys that go on over loads."""

import pytest
from pyspark.sql import functions as F

from hourstar.operators.appends import append_numbered, appended, loads


def rows(spark, start, end):
    return spark.range(start, end, 1, 5).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"), "id")


def test_loads_are_numbered_without_gaps(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert append_numbered(folder, "a", rows(spark, 500, 900), ["name"], "key") == 400
    assert append_numbered(folder, "b", rows(spark, 0, 500).repartition(7), ["name"], "key") == 900
    assert append_numbered(folder, "none", rows(spark, 0, 0), ["name"], "key") == 900
    assert append_numbered(folder, "c", rows(spark, 0, 10), ["name"], "key") == 910
    table = appended(spark, folder)
    assert dict(table.dtypes)["key"] == "int"
    found = sorted((r.key, r.id) for r in table.collect())
    assert found == list(enumerate([*range(500, 900), *range(500), *range(10)], 1))
    assert [(r.name, r.first, r.last) for r in loads(spark, folder)] == [
        ("a", 1, 400), ("b", 401, 900), ("none", 901, 900), ("c", 901, 910)]


def test_a_load_counts_once_and_a_failed_one_is_repeated(spark, tmp_path):
    folder = str(tmp_path / "t")
    append_numbered(folder, "a", rows(spark, 0, 10), ["name"], "key")
    assert append_numbered(folder, "a", rows(spark, 0, 10), ["name"], "key") == 10
    assert appended(spark, folder).count() == 10
    # A load that wrote its rows and stopped before its line leaves the table as it was.
    rows(spark, 0, 99).withColumn("key", F.lit(1)).write.parquet(f"{folder}/rows/1")
    assert appended(spark, folder).count() == 10
    assert append_numbered(folder, "b", rows(spark, 10, 15), ["name"], "key") == 15
    assert sorted(r.key for r in appended(spark, folder).collect()) == list(range(1, 16))


def test_what_cannot_be_loaded_leaves_the_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing"):
        appended(spark, folder)
    append_numbered(folder, "a", rows(spark, 0, 100), ["name"], "key", "tinyint")
    with pytest.raises(Exception, match="does not fit tinyint"):
        append_numbered(folder, "b", rows(spark, 100, 130), ["name"], "key", "tinyint")
    with pytest.raises(ValueError, match="other columns"):
        append_numbered(folder, "b", rows(spark, 100, 110).withColumn("more", F.lit(1)), ["name"], "key", "tinyint")
    assert append_numbered(folder, "b", rows(spark, 100, 120), ["name"], "key", "tinyint") == 120
    assert appended(spark, folder).count() == 120
