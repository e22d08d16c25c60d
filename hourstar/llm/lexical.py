"""Ranked lexical search by Block-Max MaxScore.

The index has a row per shard of at most ``SHARD_DOCS`` documents, made by the task that reads them. In a shard, documents are
numbered by length. A term's list of (number, occurrences) is cut into blocks of ``BLOCK`` postings, each compressed by
itself, with the largest number of occurrences and the shortest length beside it: they bound what the block can add to a
score. Only terms of the queries are indexed; a bit map of 1 MB, whatever the number of queries, tells them from others.

A shard is searched for a query like this. The kth score found so far is the threshold. Lists are ordered by their greatest
bound; the lists whose bounds together stay below the threshold are the non-essential ones: a document in no other
list cannot get in. Documents of the essential lists are the candidates. Non-essential lists follow, the
one with the largest bound first: a candidate that cannot reach the threshold with its block's bound and the bounds of
the lists still to come is rejected before the block is decompressed. Scores are exact integers. A task carries its best
ones from shard to shard; the best of all tasks are merged in two steps, so that no task gets more than a share.

Queries come to the tasks in blocks of about ``QUERY_TERMS`` terms (the block with most is measured, and more blocks are made
until none exceeds twice that; a single query is not divided); the index is passed over once per block.

Defined results. Null and empty texts have no terms: such documents are not counted in N, such queries find nothing. Ids of
documents are whole numbers; a null id comes after all others in ties. Every row is a document, also a repeated one. Rows of
one query id and text are one query; different texts under one id are searched, and ranked, each by itself. Empty
tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces
from hourstar.llm.decontaminate import MAP_BITS, bit_map
from hourstar.session import stored

SHARD_DOCS, SHARD_BYTES = 8192, 32 << 20
BLOCK = 128
QUERY_TERMS = 500_000
PART = 1 << 20  # bytes of a text that are split into terms at once
MERGE = 64  # groups of tasks whose results are merged first
KNOWN = 1_000_000  # terms a task remembers

INDEX = (
    "docs long, length long, ids array<long>, sizes array<long>, terms array<string>, counts array<int>, "
    "lasts array<int>, most array<long>, shortest array<long>, ends array<int>, postings binary"
)
# All of ASCII but letters and digits becomes a space; bytes of other characters stay.
_ASCII = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def count_terms(text: str) -> Counter:
    """Terms (UTF-8, A-Z in lower case) with their occurrences."""
    data = text.encode().lower().translate(_ASCII)
    found: Counter = Counter()
    start = 0
    while start < len(data):
        end = len(data) if len(data) - start <= PART else data.find(b" ", start + PART)
        end = len(data) if end < 0 else end
        found.update(data[start:end].split())
        start = end
    return found


class Shard:
    """Documents of a shard while it is filled."""

    def __init__(self) -> None:
        self.docs = self.length = self.bytes = 0
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.number: dict[bytes, int] = {}
        self.terms: list[int] = []
        self.owners: list[int] = []
        self.times: list[int] = []

    def add(self, doc_id: int | None, size: int, wanted: dict[bytes, int]) -> None:
        for term, times in wanted.items():
            self.terms.append(self.number.setdefault(term, len(self.number)))
            self.times.append(times)
        self.owners.extend([len(self.ids)] * len(wanted))
        self.ids.append(doc_id)
        self.sizes.append(size)

    def row(self) -> dict:
        by_size = np.argsort(np.array(self.sizes, np.int64), kind="stable")
        place = np.empty(len(by_size), np.int64)
        place[by_size] = np.arange(len(by_size))
        sizes = np.array(self.sizes, np.int64)[by_size]
        terms, times = np.array(self.terms, np.int64), np.array(self.times, np.int64)
        owners = place[np.array(self.owners, np.int64)] if self.owners else np.empty(0, np.int64)
        order = np.lexsort((owners, terms))
        owners, times = owners[order], times[order]
        counts = np.bincount(terms, minlength=len(self.number))
        lasts, most, shortest, ends, parts, end, at = [], [], [], [], [], 0, 0
        for n in counts.tolist():
            for start in range(at, at + n, BLOCK):
                stop = min(start + BLOCK, at + n)
                mine, often = owners[start:stop], times[start:stop]
                part = zlib.compress(np.diff(mine, prepend=0).astype("<u2").tobytes() + often.astype("<u4").tobytes(), 1)
                end += len(part)
                parts.append(part)
                ends.append(end)
                lasts.append(int(mine[-1]))
                most.append(int(often.max()))
                shortest.append(int(sizes[mine[0]]))
            at += n
        return {
            "docs": self.docs, "length": self.length, "ids": [self.ids[k] for k in by_size.tolist()], "sizes": sizes.tolist(),
            "terms": [t.decode() for t in self.number], "counts": counts.tolist(), "lasts": lasts, "most": most,
            "shortest": shortest, "ends": ends, "postings": b"".join(parts),
        }


INDEX_ARROW = pa.schema([
    ("docs", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
    ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32())), ("lasts", pa.list_(pa.int32())),
    ("most", pa.list_(pa.int64())), ("shortest", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("postings", pa.binary()),
])


def build_index(docs: DataFrame, table: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of the terms whose hash is in the bit map, one row per shard."""

    def is_wanted(term: bytes) -> bool:
        place = xxhash.xxh64_intdigest(term, 42) & (MAP_BITS - 1)
        return bool(table[place >> 3] >> (place & 7) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        shard = Shard()
        for piece, texts in pieces(batches, 1):
            for doc_id, text in zip(piece.column(0).to_pylist(), texts):
                found = count_terms(text)
                if not found:
                    continue
                if len(known) > KNOWN:
                    known.clear()
                for term in found:
                    if term not in known:
                        known[term] = is_wanted(term)
                size = sum(found.values())
                shard.docs += 1
                shard.length += size
                shard.bytes += len(text)
                if wanted := {t: n for t, n in found.items() if known[t]}:
                    shard.add(doc_id, size, wanted)
                if len(shard.ids) >= SHARD_DOCS or shard.bytes >= SHARD_BYTES:
                    yield pa.RecordBatch.from_pylist([shard.row()], INDEX_ARROW)
                    shard = Shard()
        yield pa.RecordBatch.from_pylist([shard.row()], INDEX_ARROW)

    return docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")).mapInArrow(run, INDEX)


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``query`` (its id and 128 bits of its text), ``term``, ``times`` of every distinct query."""
    bits = [F.xxhash64(F.lit(seed), text_col).alias(name) for seed, name in ((1, "high"), (2, "low"))]
    rows = queries.select(F.struct(queries[id_col].alias("id"), *bits).alias("query"), queries[text_col].alias("text"))
    kind = rows.schema["query"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in pieces(batches, 1):
            found = [(k, t.decode(), n) for k, text in enumerate(texts) for t, n in count_terms(text).items()]
            at, terms, times = list(zip(*found)) or ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(at, pa.int64())), pa.array(terms, pa.string()), pa.array(times, pa.int64())],
                ["query", "term", "times"],
            )

    return rows.dropDuplicates(["query"]).mapInArrow(run, f"query {kind}, term string, times long")


def impacts(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 12 * m)


def dampers(sizes: np.ndarray, docs: int, length: int) -> np.ndarray:
    """m of documents of these sizes."""
    if len(sizes) and 25 * int(sizes.max()) * docs >= 1 << 63:
        return np.array([75 + 25 * s * docs // length for s in sizes.tolist()], np.int64)
    return 75 + 25 * sizes * docs // length


class OpenShard:
    """A shard's lists; blocks are decompressed when they are first needed."""

    def __init__(self, row: dict, docs: int, length: int):
        array = {k: row[k].values.to_numpy(zero_copy_only=False) for k in ("sizes", "counts", "lasts", "most", "shortest", "ends")}
        self.missing = row["ids"].values.is_null().to_numpy(zero_copy_only=False)
        self.ids = row["ids"].values.fill_null(0).to_numpy()
        self.m = dampers(array["sizes"], docs, length)
        self.bounds = impacts(array["most"], dampers(array["shortest"], docs, length))
        self.lasts, self.ends, self.postings = array["lasts"], array["ends"], row["postings"].as_buffer()
        blocks = np.concatenate([[0], np.cumsum(-(-array["counts"].astype(np.int64) // BLOCK))])
        self.span = {t: (int(blocks[k]), int(blocks[k + 1])) for k, t in enumerate(row["terms"].values.to_pylist())}
        self.greatest = {t: int(self.bounds[a:b].max()) for t, (a, b) in self.span.items()}
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what the term gives each, before its weight."""
        if at not in self.opened:
            start = int(self.ends[at - 1]) if at else 0
            data = zlib.decompress(self.postings[start : int(self.ends[at])])
            n = len(data) // 6
            owners = np.cumsum(np.frombuffer(data, "<u2", n).astype(np.int64))
            self.opened[at] = owners, impacts(np.frombuffer(data, "<u4", n, 2 * n).astype(np.int64), self.m[owners])
        return self.opened[at]

    def search(self, query: Sequence[tuple[str, int]], threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that reach the threshold, and their scores. ``query``: terms with weights above 0."""
        lists = sorted((w * self.greatest[t], w, *self.span[t]) for t, w in query if t in self.span)
        sums = np.cumsum([u for u, *_ in lists])
        essential = int(np.searchsorted(sums, threshold))
        scores = np.zeros(len(self.ids), np.int64)
        for _, weight, start, end in lists[essential:]:
            for at in range(start, end):
                owners, gain = self.block(at)
                scores[owners] += weight * gain
        left = np.flatnonzero(scores)
        for k in range(essential - 1, -1, -1):
            _, weight, start, end = lists[k]
            below = int(sums[k - 1]) if k else 0
            left = left[scores[left] + int(sums[k]) >= threshold]
            if not len(left):
                break
            at = start + np.searchsorted(self.lasts[start:end], left)
            bound = np.where(at < end, weight * self.bounds[np.minimum(at, end - 1)], 0)
            alive = scores[left] + bound + below >= threshold
            left, at = left[alive], at[alive]
            for block in np.unique(at[at < end]).tolist():
                owners, gain = self.block(block)
                mine = left[at == block]
                place = np.searchsorted(owners, mine)
                held = owners[place] == mine
                scores[mine[held]] += weight * gain[place[held]]
        left = left[scores[left] >= max(threshold, 1)]
        return left, scores[left]


class Best:
    """The best k (score, document) found so far; ties to the smaller id, a missing one last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def threshold(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores, ids, missing = np.append(self.scores, scores), np.append(self.ids, ids), np.append(self.missing, missing)
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def search_blocks(queries: DataFrame) -> Iterator[pa.Table]:
    """``query, terms, weights`` in blocks of bounded size."""
    sized = stored(queries.groupBy("query").agg(
        F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"), F.count("*").alias("size")), "queries")
    total = sized.agg(F.sum("size")).first()[0] or 0
    number = max(1, -(-total // QUERY_TERMS))
    while True:
        dealt = sized.withColumn("block", F.pmod(F.xxhash64("query.high", "query.low"), F.lit(number)))
        largest = dealt.groupBy("block").agg(F.sum("size").alias("size"), F.count("*").alias("n")).where("n > 1").agg(F.max("size")).first()[0] or 0
        if largest <= 2 * QUERY_TERMS:
            break
        number *= 2
    for block in range(number if total else 0):
        yield dealt.where(F.col("block") == block).select("query", "terms", "weights").toArrow()


def top_documents(
    docs: DataFrame, queries: DataFrame, k: int, *, id_col: str = "doc_id", text_col: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """``query id, rank, document id, score``: the k best documents of each query; see the module's text."""
    asked = stored(query_terms(queries, query_id, query_text), "asked")
    index = stored(build_index(docs, bit_map(asked.select(F.xxhash64("term").alias("hash"))), id_col=id_col, text_col=text_col), "index")
    total = index.agg(F.sum("docs").alias("docs"), F.sum("length").alias("length")).first()
    n, length = total.docs or 0, total.length or 0
    held = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0 * n + 2)) / (2 * F.col("df") + 1)))
    weighted = asked.join(held, "term").select("query", "term", (F.col("times") * weight).cast("long").alias("weight")).where("weight > 0")
    kind = asked.schema["query"].dataType.simpleString()
    fields = f"query {kind}, task int, missing boolean, id long, score long"
    found = None
    for block in search_blocks(weighted):
        keys, terms, weights = (block.column(c).combine_chunks() for c in ("query", "terms", "weights"))
        lists = [list(zip(t, w)) for t, w in zip(terms.to_pylist(), weights.to_pylist())]

        def run(batches: Iterator[pa.RecordBatch], keys=keys, lists=lists) -> Iterator[pa.RecordBatch]:
            best = [Best(k) for _ in lists]
            for batch in batches:
                for at in range(batch.num_rows):
                    shard = OpenShard({c: batch.column(c)[at] for c in batch.schema.names}, n, length)
                    for query, own in zip(lists, best):
                        places, scores = shard.search(query, own.threshold)
                        own.add(scores, shard.ids[places], shard.missing[places])
            owner = np.repeat(np.arange(len(best)), [len(b.scores) for b in best])
            ids, missing, scores = (np.concatenate([getattr(b, c) for b in best]) for c in ("ids", "missing", "scores"))
            task = np.full(len(owner), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owner)), pa.array(task), pa.array(missing), pa.array(ids), pa.array(scores)],
                ["query", "task", "missing", "id", "score"],
            )

        part = index.mapInArrow(run, fields)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = asked.sparkSession.createDataFrame([], fields)
    order = F.col("score").desc(), "missing", "id"
    for groups in ([F.col("task") % MERGE], []):
        rank = F.row_number().over(Window.partitionBy("query", *groups).orderBy(*order))
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return found.select(
        F.col("query.id").alias(query_id), "rank", F.when(~F.col("missing"), F.col("id")).alias(id_col), "score"
    )
