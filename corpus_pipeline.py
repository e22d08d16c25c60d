"""The training-data pipeline over ``documents``: four stages, each written and read again as the next one's input.

A stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Defined results: null texts
are texts without words; every row is judged by its own text, also where ids are missing or repeated; extra columns
are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.llm import decontaminate, simhash, toxicity
from hourstar.llm.queries import encoded
from hourstar.llm.shared import send_package
from hourstar.session import scratch_path, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, fitted to the labels of this input, does not judge toxic."""
    send_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(~toxicity.is_toxic(model)(F.col("text")))


def unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def digest(*columns: Column) -> list[Column]:
    """128 bits of the values: two 64-bit hashes with different seeds. Null and empty texts differ."""
    present = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    nulls = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *nulls, *present) for seed in (1, 2)]


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, as the SimHash operator finds them, the row with the smallest id; one without an id
    last, and of several texts of an id the one with the smallest digest.

    A row is named by its id and its text's digest, so the operator's smallest name of a group is the row that
    stays. Rows that go are removed by one anti join. Rows of one id and text are copies of one row: of them, one is
    kept by the order of all their columns.
    """
    send_package(spark)
    high, low = digest(F.col("text"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", high.alias("high"), low.alias("low"))
    marked = simhash.near_duplicates(docs.select(row.alias("row"), "text"), id_col="row")
    names = stored(marked.groupBy("row").agg(F.count("*").alias("rows"), F.any_value("component_id").alias("stays")), "names")
    name = ["doc_id", "high", "low"]
    goes, twice = (stored(names.where(c).select("row.*").select(name), n) for c, n in (("row <> stays", "gone"), ("row = stays AND rows > 1", "twice")))
    key = unused(docs, "_name")
    keyed = docs.withColumn(key, F.struct("doc_id", high.alias("high"), low.alias("low")))

    def named(other: DataFrame) -> Column:
        return (F.col(f"{key}.high") == other["high"]) & (F.col(f"{key}.low") == other["low"]) & F.col(f"{key}.doc_id").eqNullSafe(other["doc_id"])

    left = keyed.join(goes, named(goes), "left_anti")
    once = left.join(twice, named(twice), "left_anti")
    # Combined before the shuffle, so a row repeated any number of times moves once per task.
    several = left.join(twice, named(twice), "left_semi").groupBy(key).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return once.select(docs.columns).unionByName(several.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each text is judged by itself, whatever its id."""
    send_package(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = unused(docs, "_digest")
    high, low = digest(F.col("text"))
    keyed = docs.withColumn(key, F.struct(high.alias("high"), low.alias("low")))
    holding = decontaminate.contaminated(keyed, items, id_col=key).select(F.col(key).alias("held")).distinct()
    holding = holding.withColumnRenamed("held", unused(keyed, "_held"))
    return keyed.join(holding, keyed[key] == F.col(holding.columns[0]), "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and the decoded texts."""
    send_package(spark)
    return encoded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# The first stages cannot be expressed in SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
