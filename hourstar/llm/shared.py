"""Sending the package to executors, and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.session import stored

JUMPS = 2

_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started, as ``--py-files`` would.

    The driver zips the package once per application and Spark hands the file to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    _sent.add(context.applicationId)


def forest(pairs: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(node, smallest node linked to it) for all nodes but the smallest: the links of one task, thinned out."""
    parent: dict[int, int] = {}

    def find(node: int) -> int:
        top = node
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[node] != top:
            parent[node], node = top, parent[node]
        return top

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    for node in list(parent):
        if (top := find(node)) != node:
            yield node, top


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node that has a link, the root being the component's smallest node.

    In each round a node takes the smallest of its neighbours as its parent, if it is smaller, and parents are
    followed ``JUMPS`` times. Then the graph is contracted: links between parents replace those between nodes, so a
    dense group shrinks to a few links at once and a chain by a factor. Rounds end when no link is left.
    Every round is written to the shared folder, so a lost executor costs that round at most.
    """
    low_high = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left = stored(low_high.where("a <> b").distinct(), "links")
    roots: DataFrame | None = None
    while roots is None or not left.isEmpty():
        both = left.union(left.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("root"))
        for _ in range(JUMPS):
            parents = stored(parents, "parents")
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            parents = parents.join(above, "root").select("node", F.col("top").alias("root"))
        parents = stored(parents, "parents")
        if roots is None:
            roots = parents
        else:
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = stored(roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
        ends = [parents.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"]
        moved = left.join(ends[0], "a").join(ends[1], "b").where("root_a <> root_b")
        left = stored(moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return roots
