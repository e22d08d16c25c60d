"""Raw readings as nested JSON documents: landing, reading back, and the completeness check."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from operator import itemgetter
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourstar import schemas
from hourstar.operators.quality import completeness, missing_keys
from hourstar.session import scratch_path, shuffle_partitions

# A landed document holds at most this many readings.
MAX_READINGS = 4096

LAYOUTS = ("file", "folder", "field", "day")

# Up to this many files are named in the plan of a second pass; more are told by a join.
NAMED_FILES = 10_000


def nest(df: DataFrame, entity: str, items: str, fields: list[Column], order: list[str],
         header: list[str] | None = None) -> DataFrame:
    """Documents of up to ``MAX_READINGS`` items, in order: ``entity``, header columns, ``items`` array.

    Rows are range-partitioned by entity and order, once, and each task cuts its sorted rows into documents where
    the entity or header changes or a document is full. An entity with a large share of the rows is split over
    many tasks and many documents, and so are equal rows, which a last column tells apart. ``order`` should list
    every column used and ``df`` come from a stored table, so that re-run tasks see the same order.
    """
    keys = [entity, *(header or [])]
    by = [*keys, *order, "_tie"]
    rows = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(*keys, F.struct(*fields).alias(items))
    )
    most = MAX_READINGS

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def starts_of(table: pa.Table) -> np.ndarray:
            """Where documents begin, if one begins at the first row."""
            places = np.arange(table.num_rows)
            change = places == 0
            for key in keys:
                codes = pc.dictionary_encode(table.column(key).combine_chunks(), null_encoding="encode").indices.to_numpy()
                change[1:] |= codes[1:] != codes[:-1]
            return np.flatnonzero((places - np.maximum.accumulate(np.where(change, places, 0))) % most == 0)

        def documents(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            values = pa.concat_arrays(table.column(items).chunks)
            lists = pa.ListArray.from_arrays(pa.array([*starts, table.num_rows], pa.int32()), values)
            heads = [pa.concat_arrays(table.column(key).chunks).take(pa.array(starts)) for key in keys]
            return pa.RecordBatch.from_arrays([*heads, lists], [*keys, items])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            starts = starts_of(table)
            # The last document may go on in the next batch.
            if len(starts) > 1:
                yield documents(table.slice(0, starts[-1]), starts[:-1])
            held = table.slice(starts[-1])
        if held is not None:
            yield documents(held, np.zeros(1, int))

    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField(items, T.ArrayType(rows.schema[items].dataType))])
    return rows.mapInArrow(gather, schema)


def epoch_day(epoch: Column) -> Column:
    """The UTC day of a Unix time."""
    return F.date_from_unix_date(F.floor(epoch / 86400).cast("int"))


def reading_documents(readings: DataFrame, entity: str = "province_name", by_day: bool = False) -> DataFrame:
    """Documents in the raw layout from flat ``(entity, latitude, longitude, dt, pm2_5)`` rows.

    With ``by_day`` a document holds readings of one UTC ``day`` only, as the layout ``day`` needs.
    """
    fields = [F.struct("pm2_5").alias("components"), F.col("dt")]
    day = ["day"] if by_day else []
    rows = readings.withColumn("day", epoch_day(F.col("dt"))) if by_day else readings
    docs = nest(rows, entity, "list", fields, ["dt", "pm2_5"], ["latitude", "longitude", *day])
    return docs.select(
        entity, F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("coord"), "list", *day
    )


def land(docs: DataFrame, path: str, entity: str = "province_name", layout: str = "field", pretty: bool = False,
         append: bool = False) -> None:
    """Write the documents as JSON lines, or over several lines each with ``pretty``.

    ``field`` keeps the entity inside the documents and packs many entities into a file; it suits
    large numbers of entities, and writes documents in the tasks that hold them. ``folder`` gives each
    entity a folder, ``day`` each day, from the column ``day``; there tasks take ranges of (folder, first reading),
    so that a large folder is written by several tasks and a small one by few. ``file`` writes one
    ``<entity>.json`` per entity, each by one task, so a very large entity suits it less than the others.
    What lies at ``path`` is replaced; ``append`` adds to it, in layouts other than ``file``.
    """
    spark = docs.sparkSession
    if layout not in LAYOUTS:
        raise ValueError(f"cannot write layout {layout!r}")
    if append and layout == "file":
        raise ValueError("files named after their entity cannot be added to")
    mode = "append" if append else "overwrite"
    if layout == "field":
        # Documents are bounded and already spread over tasks, so they are written where they are.
        docs.write.mode(mode).option("pretty", pretty).json(path)
        return
    # Opening files is the work here, which does not show in the bytes AQE goes by.
    n = shuffle_partitions(spark)
    keyed = docs.withColumn("_first", F.col("list").getItem(0)["dt"])
    if layout == "file":
        out = keyed.repartition(n, entity).sortWithinPartitions(entity, "_first").drop("_first")
    else:
        folder = entity if layout == "folder" else "day"
        by = [*dict.fromkeys([folder, entity]), "_first", "_tie"]
        out = keyed.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *by)
        if layout == "folder":
            out = out.sortWithinPartitions(*by)
        out = out.drop("_first", "_tie")
    if layout != "day" and _mounted(spark, path):
        _write_mounted(out, path, entity, layout, pretty, append)
    elif layout == "file":
        _write_named(out, path, entity, pretty)
    else:
        out.write.partitionBy(folder).mode(mode).option("pretty", pretty).json(path)


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path in the file system that all machines share, if ``path`` lies there and not in another store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _write_mounted(docs: DataFrame, path: str, entity: str, layout: str, pretty: bool, append: bool) -> None:
    """Layouts ``file`` and ``folder`` in a mounted file system: tasks write the entities' files under their final names.

    ``docs`` is sorted by entity in every task. Spark's writer takes many calls and processes per file there and moves each
    in the driver, which is most of the work where a file is small. A file gets its name when it is complete, and a repeated
    task writes the same files. Unless they are added to, all are written beside ``path`` and take its place at the end.
    Names that are no visible file name are refused before ``path`` is touched.
    """
    spark, job = docs.sparkSession, uuid.uuid4().hex
    staging = path if append else f"{path.rstrip('/')}-landing-{job}"
    below, name = _mounted(spark, staging), F.col(entity).cast("string")
    rest = [F.col(c) for c in docs.columns if c != entity]
    nameless = name.isNull() | name.isin("", "__HIVE_DEFAULT_PARTITION__") | name.rlike("^[._]|[/:]")
    text = F.to_json(F.struct(*rest), {"pretty": str(pretty).lower()})
    texts = docs.select(name.alias("name"), nameless.alias("nameless"), text.alias("text"))

    def folder_name(text: str | None) -> str:
        """As Spark escapes a column or value in the name of a partition's folder."""
        special = "[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]"
        return re.sub(special, lambda c: f"%{ord(c[0]):02X}", text or "") or "__HIVE_DEFAULT_PARTITION__"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, bool, str]]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                yield from zip(*(c.to_pylist() for c in batch.slice(start, 64).columns))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, refused = TaskContext.get(), []
        for (name, nameless), documents in groupby(rows(batches), itemgetter(0, 1)):
            if layout == "file" and nameless:
                refused = [str(name)]
                continue
            place, file = below, f"{name}.json"
            if layout == "folder":
                place, file = f"{below}/{folder_name(entity)}={folder_name(name)}", f"part-{task.partitionId():05d}-{job}.json"
                os.makedirs(place, exist_ok=True)
            hidden = f"{place}/.{job}-{task.taskAttemptId()}"
            with open(hidden, "w", encoding="utf-8", newline="") as out:
                out.writelines(f"{text}\n" for *_, text in documents)
            os.replace(hidden, f"{place}/{file}")
        yield pa.RecordBatch.from_arrays([pa.array(refused, pa.string())], ["refused"])

    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(to_path(staging))
    try:
        refused = texts.mapInArrow(write, "refused STRING").agg(F.min("refused")).first()[0]
        if refused is not None:
            raise ValueError(f"no file can be named after {refused!r}")
        if not append:
            files.delete(to_path(path), True)
            if not files.rename(to_path(staging), to_path(path)):
                raise OSError(f"cannot write {path}")
    finally:
        if not append:
            files.delete(to_path(staging), True)


def _write_named(docs: DataFrame, path: str, entity: str, pretty: bool = False) -> None:
    """Write ``<entity>.json`` files, each of which must come from one task, in any store that Spark can write.

    Spark names files itself, so they are written beside ``path``, one folder per entity, and renamed when all are
    complete. Only names pass the driver. Names that are no visible file name are refused before ``path`` is touched.
    """
    spark = docs.sparkSession
    staging = f"{path.rstrip('/')}-landing-{uuid.uuid4().hex}"
    docs.write.partitionBy(entity).option("maxRecordsPerFile", 0).option("pretty", pretty).json(staging)
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        written = {}
        for folder in files.listStatus(to_path(staging)):
            if not folder.isDirectory():
                continue
            name = unquote(folder.getPath().getName().partition("=")[2])
            if name == "__HIVE_DEFAULT_PARTITION__" or name[0] in "._" or "/" in name or ":" in name:
                raise ValueError(f"no file can be named after {name!r}")
            [part] = [f.getPath() for f in files.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            written[name] = part
        files.delete(to_path(path), True)
        files.mkdirs(to_path(path))
        for name, part in written.items():
            if not files.rename(part, to_path(to_path(path), f"{name}.json")):
                raise OSError(f"cannot write {name}.json below {path}")
    finally:
        files.delete(to_path(staging), True)


def _entity_of_file(entity: str) -> Column:
    """The entity named by ``<entity>.json``. File names are URL-encoded, save for a plus sign."""
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return F.regexp_extract(name, r"^(.*)\.json$", 1).alias(entity)


@contextmanager
def _few_listers(spark: SparkSession) -> Iterator[None]:
    """Within, folders are listed by some tasks per core, not by up to 10,000, whose start is most of the time."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, min(int(before), 8 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_landed(spark: SparkSession, path: str, entity: str = "province_name", layout: str = "file",
                files: bool = False) -> DataFrame:
    """All documents in one relation with the explicit raw schema; fields not in it are not parsed.

    The entity is the name of an ``<entity>.json`` file (``file``), of a folder (``folder``), or a
    field of the document (``field``, and ``day``, whose folders give the column ``day``). ``corrupt`` marks lines that
    are no whole document. With ``files`` the column ``file`` tells where a document lies.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout {layout!r}")
    reader = spark.read.option("pathGlobFilter", "*.json").option("columnNameOfCorruptRecord", "_corrupt")
    fields = f"{schemas.RAW}, _corrupt STRING"
    place = [F.col("_metadata.file_path").alias("file")] if files else []
    if layout == "file":
        docs = reader.schema(fields).json(path).select("*", _entity_of_file(entity), *place)
    else:
        day = ", day DATE" if layout == "day" else ""
        with _few_listers(spark):
            docs = reader.schema(f"{fields}, `{entity}` STRING{day}").json(path).select("*", *place)
    # A value too wide for its type also counts as corrupt to the reader, but leaves the other fields.
    return docs.withColumn("corrupt", F.col("_corrupt").isNotNull() & F.col("list").isNull()).drop("_corrupt")


def landed_files(spark: SparkSession, path: str, entity: str = "province_name", layout: str = "file") -> DataFrame:
    """The landed files as ``(entity, bytes)``, for layouts that name the entity in the path.

    Only the listing is used; no file is opened.
    """
    listing = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    size = F.col("length").alias("bytes")
    if layout == "file":
        return reader.load(path).select(_entity_of_file(entity), size)
    if layout == "folder":
        with _few_listers(spark):
            return reader.schema(f"{listing}, `{entity}` STRING").load(path).select(entity, size)
    raise ValueError(f"layout {layout!r} does not name entities in paths")


def explode_readings(docs: DataFrame, entity: str = "province_name", keep_empty: bool = False) -> DataFrame:
    """One row per reading. Documents without readings give none, or with ``keep_empty`` one row of nulls."""
    explode = F.explode_outer if keep_empty else F.explode
    kept = [F.col(c) for c in ("corrupt", "file") if c in docs.columns]
    return docs.select("coord", entity, *kept, explode("list").alias("record")).select(
        F.col("coord.lat").alias("latitude"),
        F.col("coord.lon").alias("longitude"),
        entity,
        F.timestamp_seconds("record.dt").alias("datetime"),
        F.col("record.components.pm2_5").alias("pm2_5"),
        *kept,
    )


def readings_between(spark: SparkSession, path: str, start: int, end: int, entity: str = "province_name") -> DataFrame:
    """The readings between two Unix times, both inclusive, of documents landed by day.

    The days become literals that select folders, so files of other days are neither opened nor parsed.
    """
    days = F.col("day").between(epoch_day(F.lit(start)), epoch_day(F.lit(end)))
    readings = explode_readings(read_landed(spark, path, entity, "day").where(days), entity)
    return readings.where(F.col("datetime").between(F.timestamp_seconds(F.lit(start)), F.timestamp_seconds(F.lit(end))))


def broken_files(readings: DataFrame) -> DataFrame:
    """The files (``file``) with corrupt lines and no reading, such as pretty-printed ones.

    ``readings`` comes from ``read_landed(.., files=True)`` and ``explode_readings(.., keep_empty=True)``.
    """
    counts = readings.groupBy("file").agg(F.count_if("corrupt").alias("bad"), F.count("datetime").alias("readings"))
    return counts.where("bad > 0 AND readings = 0").select("file")


def read_whole(spark: SparkSession, path: str, broken: DataFrame, entity: str = "province_name", layout: str = "file") -> DataFrame:
    """The documents of the ``broken`` files, read as running JSON: a document, or several, over any number of lines.

    Only those files are opened: up to NAMED_FILES are named in the plan, so that the scan leaves the others out;
    more are told by a join. A file is one value here, so one task reads it. What follows a place that cannot be
    read makes one corrupt row. An array at the top stands for its documents.
    """
    reader = spark.read.option("pathGlobFilter", "*.json")
    file = F.col("_metadata.file_path").alias("file")
    if layout == "file":
        texts = reader.text(path, wholetext=True).select("value", file, _entity_of_file(entity))
    elif layout == "folder":
        with _few_listers(spark):
            texts = reader.schema(f"value STRING, `{entity}` STRING").text(path, wholetext=True).select("value", file, entity)
    else:
        texts = reader.schema("value STRING" + (", day DATE" if layout == "day" else "")).text(path, wholetext=True).select(
            "value", file, F.lit(None).cast("string").alias(entity))
    names = [r.file for r in broken.limit(NAMED_FILES + 1).collect()]
    if len(names) <= NAMED_FILES:
        texts = texts.where(F.col("file").isin(names))
    else:
        texts = texts.join(broken, "file", "left_semi").select(*texts.columns)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = json.JSONDecoder()
        for batch in batches:
            for text, file, name in zip(*(c.to_pylist() for c in batch.columns)):
                found, at = [], 0
                while at < len(text):
                    if text[at].isspace():
                        at += 1
                        continue
                    try:
                        end = decoder.raw_decode(text, at)[1]
                    except (ValueError, RecursionError):
                        found.append(None)
                        break
                    found.append(text[at:end])
                    at = end
                names = [[file] * len(found), [name] * len(found), found]
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in names], ["file", "name", "document"])

    inside = "" if layout in ("file", "folder") else f", `{entity}` STRING"
    parts = texts.mapInArrow(split, "file STRING, name STRING, document STRING")
    parsed = parts.withColumn("parsed", F.from_json("document", f"ARRAY<STRUCT<{schemas.RAW}{inside}>>"))
    docs = parsed.withColumn("corrupt", F.col("parsed").isNull()).select("file", "name", "corrupt", F.explode_outer("parsed").alias("d"))
    name = F.col(f"d.`{entity}`") if inside else F.col("name")
    return docs.select("d.coord", "d.list", name.alias(entity), "file", "corrupt")


def with_broken_files(spark: SparkSession, readings: DataFrame, path: str, store: str, entity: str = "province_name",
                      layout: str = "file") -> DataFrame:
    """Stored ``readings`` (see ``broken_files``) with those of broken files read whole.

    These are stored at ``store``, the broken files' names at ``<store>-files``. If no line is corrupt, nothing is read again.
    """
    if readings.where("corrupt").isEmpty():
        return readings
    broken_files(readings).write.mode("overwrite").parquet(f"{store}-files")
    broken = spark.read.schema("file STRING").parquet(f"{store}-files")
    whole = explode_readings(read_whole(spark, path, broken, entity, layout), entity, keep_empty=True)
    whole.select(*readings.columns).write.mode("overwrite").parquet(store)
    kept = readings.join(broken, "file", "left_anti").select(*readings.columns)
    return kept.unionByName(spark.read.schema(readings.schema).parquet(store))


def between_epochs(df: DataFrame, epoch: str, start: Column | int, end: Column | int) -> DataFrame:
    """Rows whose Unix time lies in the closed range."""
    return df.filter(F.col(epoch).between(start, end))


def between_walls(df: DataFrame, time: str, start: str, end: str, zone: str) -> DataFrame:
    """Rows whose UTC wall time (timestamp_ntz) lies between two local times of a zone, both inclusive.

    The bounds, not the column, are converted: they fold to literals that reach the scan.
    """
    def utc(text: str) -> Column:
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.to_timestamp_ntz(F.lit(text)))

    return df.filter(F.col(time).between(utc(start), utc(end)))


class LandingError(RuntimeError):
    """The landing is empty or incomplete."""


def require_all(expected: DataFrame, found: DataFrame, entity: str = "province_name", listed: str | None = None) -> int:
    """How many entities were expected, if all of them were found; raises otherwise.

    All missing entities are written as a table, below ``listed`` or in the shared folder, and the
    error names it.
    """
    if found.isEmpty():
        raise LandingError("nothing has landed")
    counts = completeness(expected, found, entity).first()
    if counts.missing:
        path = f"{listed.rstrip('/')}/missing-{uuid.uuid4().hex}" if listed else scratch_path(expected.sparkSession, "missing")
        missing_keys(expected, found, entity).write.parquet(path)
        raise LandingError(f"{counts.missing} of {counts.expected} missing, listed in {path}")
    return counts.expected


def landing_status(expected: DataFrame, readings: DataFrame, entity: str = "province_name") -> DataFrame:
    """Every expected entity with its readings and corrupt lines, and ``ok``, ``corrupt``, ``missing`` or ``no readings``.

    ``readings`` comes from ``explode_readings(.., keep_empty=True)``. The lines of a pretty-printed
    file are no documents, so it shows up as ``corrupt`` unless ``with_broken_files`` has read it.
    """
    corrupt = F.count_if("corrupt") if "corrupt" in readings.columns else F.lit(0).cast("long")
    found = readings.groupBy(entity).agg(F.count("datetime").alias("readings"), corrupt.alias("corrupt"))
    status = (
        F.when(F.col("readings").isNull(), "missing").when(F.col("corrupt") > 0, "corrupt")
        .when(F.col("readings") == 0, "no readings").otherwise("ok")
    )
    return (
        expected.select(entity).distinct().join(found, entity, "left")
        .withColumn("status", status)
        .fillna(0, ["readings", "corrupt"])
    )
