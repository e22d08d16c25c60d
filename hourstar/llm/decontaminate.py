"""Finding benchmark items inside documents by MinHash containment.

Items are short, documents long, so the share of an item's shingles that a document holds says whether the
item is inside; their Jaccard similarity says little. Items are partitioned by size, each partition with its
own sketch length. Shingles are ordered by one MinHash function, and an item's sketch is its ``m`` smallest, with
``m`` one more than the shingles that an item of the partition's largest size may lack. A document that
holds ``THRESHOLD`` of an item therefore holds one of its sketch: no item inside is missed. Documents with fewer shingles than
the threshold asks of a partition's smallest item are no candidates for it.

Documents are passed over once. Two bit maps of fixed size go out with the tasks: one of the sketches' hashes,
one of all items' hashes. A document without a sketch hit yields nothing; any other yields one row, its
shingles on the second map. Documents that hit the same shingles share one set, which is joined to the items
once, by the shingles' text: that count is the exact containment. Bit maps only let through too much, never
too little; how full they are follows from the benchmark's size alone.

Defined results. Words: runs of letters, digits and underscores, lower case; shingles of 5 words; fewer words: the whole
sequence, so an item of fewer than 5 words is only found in a document that has just these words. Null and
empty texts match nothing. Items with an equal id, or without one, are searched for each by their own text; those with the
same shingles, too, count as one. Repeated document rows yield repeated results; null ids stay null. Empty tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces
from hourstar.session import stored

WORDS = 5
THRESHOLD = 0.8
MAP_BITS = 1 << 23  # 1 MB each; with a million item shingles, one in eight of other shingles passes
KNOWN_WORDS = 500_000
_WORD = re.compile(r"\w+")
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 1], np.uint64)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found
        return found


@lru_cache(maxsize=1)
def word_hashes() -> WordHashes:
    return WordHashes()


def shingle_hashes(words: list[str]) -> np.ndarray:
    """The MinHash value of every shingle, from the hashes of its words."""
    if not words:
        return np.empty(0, np.uint64)
    known = word_hashes()
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    length = min(WORDS, len(words))
    total = np.zeros(len(words) - length + 1, np.uint64)
    for k in range(length):
        total += each[k : k + len(total)] * _FACTORS[k]
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ total >> np.uint64(32)


def shingle(words: list[str], at: int) -> str:
    return " ".join(words[at : at + WORDS])


def item_shingles(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, part, shingle, hash``, distinct; ``part`` tells the texts of one id apart, by their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in pieces(batches, 1):
            rows: list[int] = []
            parts: list[int] = []
            shingles: list[str] = []
            hashes = [np.empty(0, np.uint64)]
            for row, text in enumerate(texts):
                words = _WORD.findall(text.lower())
                found = shingle_hashes(words)
                rows += [row] * len(found)
                parts += [xxhash.xxh64_intdigest(np.unique(found).tobytes()) - (1 << 63)] * len(found)
                shingles += [shingle(words, at) for at in range(len(found))]
                hashes.append(found)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(rows, pa.int32())), pa.array(parts, pa.int64()), pa.array(shingles, pa.string()),
                 pa.array(np.concatenate(hashes).view(np.int64))],
                ["item", "part", "shingle", "hash"],
            )

    rows = items.select(items[id_col].alias("item"), items[text_col].alias("text"))
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, part long, shingle string, hash long").distinct()


def allowed_gaps(size: Column) -> Column:
    """How many of ``size`` shingles may be lacking at the threshold."""
    return (size - F.ceil(size * F.lit(THRESHOLD) - F.lit(1e-9))).cast("long")


def sketched(shingles: DataFrame) -> DataFrame:
    """Adds ``size`` (the item's), ``least`` (its partition's smallest size), ``in_sketch``."""
    sizes = shingles.groupBy("item", "part").agg(F.count("*").alias("size"))
    same = shingles["item"].eqNullSafe(sizes["item"]) & (shingles["part"] == sizes["part"])
    sized = shingles.join(sizes, same).drop(sizes["item"], sizes["part"])
    # Partitions of sizes 2^k to 2^(k+1) - 1.
    least = F.call_function("shiftleft", F.lit(1).cast("long"), F.floor(F.log2("size") + 1e-12).cast("int"))
    own = sized.withColumn("least", least).withColumn("sketch", allowed_gaps(2 * F.col("least") - 1) + 1)
    # Hashes as unsigned numbers, smallest first.
    order = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    ranked = own.withColumn("order", order).groupBy("item", "part").agg(
        F.sort_array(F.collect_list(F.struct("order", "shingle", "hash"))).alias("all"), F.first("size").alias("size"),
        F.first("least").alias("least"), F.first("sketch").alias("sketch"),
    )
    return ranked.select("item", "part", "size", "least", "sketch", F.posexplode("all").alias("at", "s")).select(
        "item", "part", "size", "least", "s.shingle", "s.hash", (F.col("at") < F.col("sketch")).alias("in_sketch")
    )


def bit_map(hashes: DataFrame) -> np.ndarray:
    """Booleans by ``hash mod MAP_BITS``. At most MAP_BITS / 64 rows come to the driver, however many hashes."""
    place = F.pmod(F.col("hash"), F.lit(MAP_BITS))
    words = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))).alias("bits")
    ).toArrow()
    table = np.zeros(MAP_BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def contaminated(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``id, item_id, shared, item_shingles, containment`` for every document row and item inside it."""
    held = stored(sketched(item_shingles(items, item_id, item_text)), "items")
    every, sketch = bit_map(held), bit_map(held.where("in_sketch"))
    smallest = held.agg(F.min("least")).first()[0] or 1

    def on(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = hashes & np.uint64(MAP_BITS - 1)
        return table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1) == 1

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in pieces(batches, 1):
            rows, sizes, sets = [], [], []
            for row, text in enumerate(texts):
                words = _WORD.findall(text.lower())
                hashes = shingle_hashes(words)
                if len(hashes) < THRESHOLD * smallest or not on(sketch, hashes).any():
                    continue
                rows.append(row)
                sizes.append(len(hashes))
                sets.append(sorted({shingle(words, at) for at in np.flatnonzero(on(every, hashes)).tolist()}))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(rows, pa.int32())), pa.array(sizes, pa.int64()),
                 pa.array(sets, pa.list_(pa.string()))],
                ["id", "doc_size", "shingles"],
            )

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    probed = rows.mapInArrow(probe, f"id {kind}, doc_size long, shingles array<string>")
    hits = stored(probed.withColumn("set", F.sha2(F.array_join("shingles", "\n"), 256)), "hits")
    sets = hits.groupBy("set").agg(F.first("shingles").alias("shingles"), F.max("doc_size").alias("doc_size"))
    verified = (
        sets.select("set", "doc_size", F.explode("shingles").alias("shingle")).join(held, "shingle")
        .where(F.col("doc_size") >= F.ceil(F.col("least") * THRESHOLD))
        .groupBy("set", "item", "part").agg(
            F.count("*").alias("shared"), F.first("size").alias("item_shingles"), F.max("in_sketch").alias("candidate"))
        .where(F.col("candidate") & (F.col("item_shingles") - F.col("shared") <= allowed_gaps(F.col("item_shingles"))))
    )
    return hits.join(verified, "set").select(
        F.col("id").alias(id_col), F.col("item").alias(item_id), "shared", "item_shingles",
        (F.col("shared") / F.col("item_shingles")).alias("containment"),
    )
