"""Exact top-k search by inner product with cover trees of queries and data.

The cover tree's top level is spread over the cluster: rows go to the nearest of at most ``GROUPS`` pivots, which are
distinct vectors of the data chosen by hash, and a group has its pivot as centre and its largest distance as covering
radius. Groups are dealt by hash over shards of bounded size. A query searches the shard it lies in first; with the kth score found
there, it is sent only to shards of groups whose bound, as below, reaches that score. Shards that no query is sent to are not
moved, others once per block of ``BLOCK_ROWS`` queries. Each (shard, block) task builds a cover tree of either and traverses both
together. A node has a centre point and the largest distance from it to a point below, its covering radius. For a query node (centre q, radius r) and a data node
(centre p, radius s) no pair below them has an inner product above

    <q, p> + r |p| + s |q| + r s,

so the pair of nodes is dropped if that is less than the worst kth score of the query node's points. Where vectors have no
clusters, radii are about as large as norms, nothing is dropped, and every query meets every row once.
Nodes split by their farthest points until they are small; two leaves are compared at once. The best k of every
shard are merged by a window over at most k rows per shard and query.

Vectors are integers, floor(scale * x). Products are taken in doubles where they are exact (squared norms below 2^53)
and otherwise in Python integers. Scores that do not fit a long are an error.

Defined results. Vectors that are null or hold null, NaN or infinite components, and rows with null ids, take no
part; vectors of unlike lengths are compared within a length only. A query never finds a row with its own id. Ties go to smaller ids, repeated rows
are found each. A repeated query row asks once; different vectors of one query id have ``k`` neighbours and ranks
each. Fewer than k candidates: all of them. Empty table or no queries: no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hourstar.session import stored

SCALE = 1024
SHARD_ROWS = 8192
GROUPS = 1024
BLOCK_ROWS = 2048
LEAF = 48
EXACT = float(1 << 53)


class Tree(NamedTuple):
    """Nodes in arrays, parents first. Points are reordered so that a node's are ``start:end``."""

    order: np.ndarray
    start: list[int]
    end: list[int]
    centre: list[int]
    radius: list[float]
    children: list[tuple[int, ...]]


def cover_tree(points: np.ndarray) -> Tree:
    """Children of a node are centred at points far from each other, every point below the nearest of them."""
    order = np.arange(len(points))
    start, end, centre, radius, children = [0], [len(points)], [0], [0.0], [()]
    todo = [0]
    while todo:
        node = todo.pop()
        own = order[start[node] : end[node]]
        distance = np.linalg.norm(points[own] - points[centre[node]], axis=1)
        # Rounding must not make a radius too small.
        radius[node] = float(distance.max()) * (1 + 1e-9)
        if len(own) <= LEAF or radius[node] == 0:
            continue
        # Farthest-first centres, down to half the radius or eight of them.
        centres, nearest = [centre[node]], np.zeros(len(own), int)
        while len(centres) < 8 and distance.max() > radius[node] / 2 or len(centres) == 1:
            far = int(own[distance.argmax()])
            new = np.linalg.norm(points[own] - points[far], axis=1)
            nearest[new < distance] = len(centres)
            distance = np.minimum(distance, new)
            centres.append(far)
        order[start[node] : end[node]] = own[np.argsort(nearest, kind="stable")]
        counts = np.bincount(nearest, minlength=len(centres))
        at, kids = start[node], []
        for c, n in zip(centres, counts.tolist()):
            if n:
                kids.append(len(start))
                todo.append(len(start))
                start.append(at)
                end.append(at + n)
                centre.append(c)
                radius.append(0.0)
                children.append(())
                at += n
        children[node] = tuple(kids)
    return Tree(order, start, end, centre, radius, children)


def search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int,
           reached: np.ndarray | None = None) -> Iterator[tuple[int, int, int]]:
    """(query row, data row, score) of each query's best k; arrays of whole numbers, as doubles or as objects.

    ``reached`` are scores that each query's kth is known to reach; lower ones need not be found.
    """
    exact = queries.dtype != object
    bound_q, bound_d = (queries, data) if exact else (queries.astype(float), data.astype(float))
    q, d = cover_tree(bound_q), cover_tree(bound_d)
    norm_q, norm_d = np.linalg.norm(bound_q, axis=1), np.linalg.norm(bound_d, axis=1)
    centre_scores = bound_q[q.centre] @ bound_d[d.centre].T
    # Best so far, worst last: score, then id.
    best: list[list[tuple]] = [[] for _ in queries]
    worst = np.full(len(queries), -np.inf) if reached is None else reached.astype(float)
    slack = 1e-9 * (norm_q.max() * norm_d.max() + 1)

    def below(score) -> float:
        """The score as a double that is not above it."""
        return float(score) if exact else float(score) - abs(float(score)) * 1e-9

    def bound(a: int, b: int) -> float:
        r, s = q.radius[a], d.radius[b]
        return centre_scores[a, b] + r * norm_d[d.centre[b]] + s * norm_q[q.centre[a]] + r * s + slack

    def compare(a: int, b: int) -> None:
        rows, columns = q.order[q.start[a] : q.end[a]], d.order[d.start[b] : d.end[b]]
        scores = queries[rows] @ data[columns].T
        allowed = data_ids[columns] != query_ids[rows][:, None]
        if exact:
            allowed &= scores >= worst[rows][:, None]
        for at in np.flatnonzero(allowed.any(axis=1)).tolist():
            row, own = int(rows[at]), np.flatnonzero(allowed[at])
            values, ids = -scores[at, own], data_ids[columns[own]]
            # The k best of the leaf are enough; equal scores in order of id.
            first = np.lexsort((ids, values))[:k] if exact else sorted(range(len(own)), key=lambda i: (values[i], ids[i]))[:k]
            ranked = list(zip(values[first].tolist(), ids[first].tolist(), columns[own[first]].tolist()))
            best[row] = sorted(best[row] + ranked)[:k]
            if len(best[row]) == k:
                worst[row] = max(worst[row], below(-best[row][-1][0]))

    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        if bound(a, b) < worst[q.order[q.start[a] : q.end[a]]].min():
            continue
        if not q.children[a] and not d.children[b]:
            compare(a, b)
            continue
        # The wider node splits; the best pair is looked at first.
        if q.children[a] and (q.radius[a] >= d.radius[b] or not d.children[b]):
            pairs = [(c, b) for c in q.children[a]]
        else:
            pairs = [(a, c) for c in d.children[b]]
        todo.extend(sorted(pairs, key=lambda p: bound(*p)))
    for row, ranked in enumerate(best):
        for negative, _, column in ranked:
            yield row, column, -int(negative)


def whole_numbers(vectors: pd.Series) -> np.ndarray:
    """floor(SCALE * x) as doubles, or as Python integers where products of doubles may not be exact."""
    scaled = np.floor(np.array(vectors.tolist(), dtype=np.float64) * SCALE)
    if not scaled.size or (scaled**2).sum(axis=1).max() < EXACT:
        return scaled
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


class Group(NamedTuple):
    """Rows of one length nearest to one pivot; without a pivot, all rows of the lengths that have none."""

    pivot: np.ndarray | None
    radius: float
    shards: int


def pivots_of(vectors: DataFrame, rows: int) -> list[np.ndarray]:
    """At most ``GROUPS`` distinct vectors, those of the smallest hashes below a limit that about twice as many pass."""
    wanted = min(GROUPS, -(-rows // SHARD_ROWS))
    some = vectors.withColumn("hash", F.xxhash64("vector", F.lit(1)))
    limit = min(2**40, 2**41 * wanted // max(1, rows))
    few = some.where(F.pmod("hash", F.lit(2**40)) < limit).select("hash", "vector").distinct().orderBy("hash", "vector").limit(wanted)
    return [whole_numbers(pd.Series([r.vector]))[0].astype(float) for r in few.collect()]


def nearest(pivots: list[np.ndarray]):
    """Number and distance of the pivot nearest to a vector, among those of its length; no pivot: their count."""

    def run(vectors: pd.Series) -> pd.DataFrame:
        group, distance = np.full(len(vectors), len(pivots)), np.full(len(vectors), np.inf)
        lengths = vectors.map(len).to_numpy()
        for length in np.unique(lengths):
            numbers = [g for g, p in enumerate(pivots) if len(p) == length]
            at = np.flatnonzero(lengths == length)
            if numbers:
                points, centres = whole_numbers(vectors.iloc[at]).astype(float), np.array([pivots[g] for g in numbers])
                best = ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)
                group[at] = np.array(numbers)[best]
                distance[at] = np.linalg.norm(points - centres[best], axis=1)
        return pd.DataFrame({"group": group.astype("int32"), "distance": distance})

    return pandas_udf(run, "group int, distance double")


def groups_to_visit(groups: list[Group]):
    """Groups that may hold a score of at least ``kth``."""

    def run(vectors: pd.Series, kth: pd.Series) -> pd.Series:
        out: list[list[int]] = [[] for _ in vectors]
        lengths, known = vectors.map(len).to_numpy(), kth.fillna(-np.inf).to_numpy(float)
        for length in np.unique(lengths):
            numbers = [g for g, x in enumerate(groups) if x.pivot is not None and len(x.pivot) == length]
            at = np.flatnonzero(lengths == length)
            points = whole_numbers(vectors.iloc[at]).astype(float)
            reaches = np.ones((len(at), 0), bool)
            if numbers:
                centres, radii = np.array([groups[g].pivot for g in numbers]), np.array([groups[g].radius for g in numbers])
                norms = np.linalg.norm(points, axis=1)[:, None]
                bounds = points @ centres.T + norms * radii
                slack = 1e-9 * (norms * (np.linalg.norm(centres, axis=1) + radii) + np.abs(known[at])[:, None] * np.isfinite(known[at])[:, None] + 1)
                # What cannot be bounded in doubles is visited.
                reaches = ~(bounds + slack < known[at][:, None])
            else:
                numbers, reaches = [g for g, x in enumerate(groups) if x.pivot is None], np.ones((len(at), 1), bool)
            for row, line in zip(at.tolist(), reaches):
                out[row] = [g for g, yes in zip(numbers, line) if yes]
        return pd.Series(out)

    return pandas_udf(run, "array<int>")


def shards_of(groups: list[Group], group) -> Column:
    return F.get(F.array(*[F.lit(g.shards) for g in groups]), group)


def best_of(k: int):
    """The search of one (shard, block) as a function of cogrouped frames."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns: dict[str, list] = {"query_id": [], "query": [], "id": [], "score": []}
        if len(left) and len(right):
            queries, rows = whole_numbers(left["vector"]), whole_numbers(right["vector"])
            if queries.dtype != rows.dtype:
                queries, rows = (x if x.dtype == object else np.array([[int(v) for v in r] for r in x], dtype=object) for x in (queries, rows))
            elif queries.dtype != object and (queries**2).sum(axis=1).max() * (rows**2).sum(axis=1).max() >= EXACT**2:
                queries, rows = (np.array([[int(v) for v in r] for r in x], dtype=object) for x in (queries, rows))
            ids, others = left["id"].to_numpy(), right["id"].to_numpy()
            own, kth = left["query"].to_numpy(), left["kth"].astype("float64").fillna(-np.inf).to_numpy()
            if queries.dtype == object:
                kth = kth - np.where(np.isfinite(kth), np.abs(kth), 0) * 1e-9
            for row, column, value in search(queries, ids, rows, others, k, kth):
                columns["query_id"].append(ids[row])
                columns["query"].append(own[row])
                columns["id"].append(others[column])
                columns["score"].append(value)
        return pd.DataFrame(columns).astype("int64")

    return run


def grouped(vectors: DataFrame) -> tuple[DataFrame, list[Group]]:
    """The rows with their group and shard, stored, and the groups."""
    pivots = pivots_of(vectors, vectors.count())
    placed = stored(vectors.withColumn("near", nearest(pivots)("vector")).select("*", "near.*").drop("near"), "vectors")
    found = {r.group: r for r in placed.groupBy("group").agg(F.count("*").alias("rows"), F.max("distance").alias("radius")).collect()}
    groups = []
    for g, pivot in enumerate([*pivots, None]):
        rows, radius = (found[g].rows, found[g].radius) if g in found else (0, 0.0)
        # Rounding must not make a radius too small.
        groups.append(Group(pivot, radius * (1 + 1e-9), -(-rows // SHARD_ROWS)))
    # Rows of one id are dealt by their vectors, too, so that a repeated id does not fill a shard.
    return placed.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), shards_of(groups, F.col("group"))).cast("int")), groups


def queries_at_home(data: DataFrame, is_query) -> DataFrame:
    """The distinct queries, each at the shard it lies in. Columns get names of their own, apart from the data's in a plan of both."""
    rows = data.where(is_query(F.col("id"))).dropDuplicates(["id", "vector"])
    return rows.select(*[F.col(c).alias(c) for c in rows.columns], F.xxhash64("vector").alias("query"), F.lit(None).cast("long").alias("kth"))


def visits(home: DataFrame, found: DataFrame, groups: list[Group], k: int) -> DataFrame:
    """One row per query and shard it must still be sent to; ``found`` is what it has found in the shard it lies in."""
    kth = found.groupBy("query_id", "query").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    kth = kth.select(F.col("query_id").alias("id"), "query", F.when(F.col("n") >= k, F.col("worst")).alias("kth"))
    asked = home.drop("kth").join(kth, ["id", "query"], "left")
    sent = asked.withColumn("to", F.explode(groups_to_visit(groups)("vector", "kth"))).where(shards_of(groups, F.col("to")) > 0)
    sent = sent.withColumn("at", F.explode(F.sequence(F.lit(0), shards_of(groups, F.col("to")) - 1)))
    sent = sent.where((F.col("to") != F.col("group")) | (F.col("at") != F.col("shard")))
    return sent.select("id", "vector", "length", "query", "kth", F.col("to").alias("group"), F.col("at").alias("shard"))


def top_k(df: DataFrame, is_query, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id, score``: each query's best ``k`` of all other rows; ``is_query`` is a condition on ``id``."""
    vectors = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & (F.abs(x * SCALE) < float("inf")))
    vectors = vectors.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)).where(sound)
    data, groups = grouped(vectors.withColumn("length", F.size("vector")))
    home = queries_at_home(data, is_query)
    kind = vectors.schema["id"].dataType.simpleString()
    result = f"query_id {kind}, query long, id {kind}, score long"
    place = ("group", "shard", "length")
    near = stored(home.groupBy(*place).cogroup(data.groupBy(*place)).applyInPandas(best_of(k), result), "near")
    sent = stored(visits(home, near, groups, k), "sent")
    blocks = sent.groupBy("group", "shard").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    asked = sent.join(blocks, ["group", "shard"]).withColumn("block", F.pmod(F.xxhash64("id", "vector", F.lit(2)), F.col("blocks").cast("long"))).drop("blocks")
    copies = blocks.select("group", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("block"))
    visited = data.join(stored(copies, "copies"), ["group", "shard"])
    place = (*place, "block")
    far = asked.groupBy(*place).cogroup(visited.groupBy(*place)).applyInPandas(best_of(k), result)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "id")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
