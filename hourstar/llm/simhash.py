"""Near-duplicates by SimHash fingerprints, found through Golay codes.

Fingerprints of 64 bits are cut into segments of 22, 21 and 21 bits. The perfect Golay code of length 23
puts every word within 3 bits of exactly one of 4096 codewords; a segment, filled up with zeros, decodes to
that codeword's index. *Nearby* indices are those of the segment and of its 23 neighbours at one bit: one
index if the segment is within 2 bits of its codeword, else up to six. Two segments at a distance of 1 have the
index of the one among the nearby ones of the other; two at a distance of 2 have a nearby index in common, that
of a word between them.

At most 4 differing bits over three segments leave either a segment without error, and then another
with two at most, or one or two errors in every segment. So these keys miss no link:

* for ordered pairs of segments: the first as it is, with each nearby index of the second (33 bits);
* the triples of nearby indices of all three segments (36 bits).

They are long enough that fingerprints of unrelated texts hardly ever meet, also among 10^9 of them.

Only distinct fingerprints get keys. Within a key the fingerprints are linked by a breadth-first search that
verifies distances and returns each found one with the smallest of its part: as many rows as members, not
pairs. A large group of copies is one fingerprint. Near copies under one key are at most the distinct
fingerprints of that key, 8 bytes each; each search step compares one with those not yet reached, so a
dense group is done in few steps.

Defined results. Words: runs without ASCII white space of the text with A-Z lower-cased; shingles of 4 words;
fewer words: the whole sequence; none (null, empty, white space): fingerprint zero, linked like any other.
Rows with null ids get the smallest id of their component, null if it has none. Repeated rows are
kept. Empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces
from hourstar.llm.shared import components, forest
from hourstar.session import stored

WORDS = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, length
# Fixed value: the generator polynomial of the Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
# Fingerprints per task when keys are made and searched; a fingerprint has about 180 keys of 16 bytes.
PER_TASK = 20_000


def fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + WORDS]) for i in range(max(1, len(words) - WORDS + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 65_536):  # a text of any length in bounded memory
        part = hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, id_col: str, text_col: str) -> DataFrame:
    """``id, fp`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in pieces(batches, 1):
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found)], ["id", "fp"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


@lru_cache(maxsize=1)
def golay_indices() -> np.ndarray:
    """The codeword index of every word of 23 bits, through the syndromes of all errors of up to 3 bits."""

    def remainder(words: np.ndarray) -> np.ndarray:
        words = words.copy()
        for bit in range(22, 10, -1):
            words ^= (words >> bit & 1) * np.int32(GENERATOR << (bit - 11))
        return words

    bits = [1 << b for b in range(23)]
    errors = np.array([sum(c) for k in range(4) for c in combinations(bits, k)], np.int32)
    error_of = np.zeros(2048, np.int32)
    error_of[remainder(errors)] = errors
    found = np.empty(1 << 23, np.int16)
    for start in range(0, 1 << 23, 1 << 18):
        words = np.arange(start, start + (1 << 18), dtype=np.int32)
        # Message bits stand first in a codeword, so its upper 12 bits are its index.
        found[start : start + (1 << 18)] = (words ^ error_of[remainder(words)]) >> 11
    return found


def nearby(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each segment; and all nearby ones, by column, -1 where one is repeated."""
    index = golay_indices()
    around = np.concatenate([segment[:, None], segment[:, None] ^ (1 << np.arange(23))], axis=1)
    found = np.sort(index[around].astype(np.int64), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    # At most six are left; they move to the first columns.
    found = -np.sort(-found, axis=1)[:, :6]
    return index[segment].astype(np.int64), found


def keys_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every key of every fingerprint, and the position of its fingerprint."""
    value = fps.view(np.uint64)
    segments = [(value >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    coded = [nearby(s) for s in segments]
    keys, owners = [], []

    def add(kind: int, found: np.ndarray, valid: np.ndarray) -> None:
        rows, _ = np.nonzero(valid)
        keys.append(found[valid] | kind << 40)
        owners.append(rows)

    for kind, (i, j) in enumerate(permutations(range(3), 2)):
        near = coded[j][1]
        add(kind, segments[i][:, None] << 12 | np.where(near < 0, 0, near), near >= 0)
    triples = np.zeros((len(value), 1), np.int64)
    valid = np.ones((len(value), 1), bool)
    for _, near in coded:
        triples = (triples[:, :, None] << 12 | np.where(near < 0, 0, near)[:, None, :]).reshape(len(value), -1)
        valid = (valid[:, :, None] & (near >= 0)[:, None, :]).reshape(len(value), -1)
    add(6, triples, valid)
    return np.concatenate(keys), np.concatenate(owners)


def linked_parts(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """(member, smallest member) for the members of each linked part but the smallest itself."""
    left = np.unique(fps.view(np.uint64))
    while len(left) > 1:
        part, frontier = [left[0]], [left[0]]
        left = left[1:]
        while frontier and len(left):
            close = np.bitwise_count(left ^ frontier.pop()) <= MAX_BITS
            if close.any():
                part.extend(left[close])
                frontier.extend(left[close])
                left = left[~close]
        signed = np.sort(np.array(part, np.uint64).view(np.int64))
        for member in signed[1:].tolist():
            yield member, int(signed[0])


def links(fps: DataFrame) -> DataFrame:
    """``a, b``: links of distinct fingerprints (column ``fp``) that span every component."""
    spark = fps.sparkSession
    tasks = max(1, -(-fps.count() // PER_TASK))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for start in range(0, len(values), 4096):
                part = values[start : start + 4096]
                keys, owners = keys_of(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[owners])], ["key", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if not got:
            return
        keys, values = (np.concatenate(x) for x in zip(*got))
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        ends = np.append(starts[1:], len(keys))
        several = ends - starts > 1
        pairs = (p for s, e in zip(starts[several], ends[several]) for p in linked_parts(values[s:e]))
        a, b = zip(*found) if (found := list(forest(pairs))) else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = fps.repartition(max(tasks, 1)).mapInArrow(spread, "key long, fp long")
    return keyed.repartition(max(tasks, least), "key").mapInArrow(search, "a long, b long").distinct()


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fingerprint`` (16 lower-case hex digits), ``component_id`` of every row; see the module's text.

    Ids of any type with an order will do, also a struct that tells rows of one id apart.
    """
    kept = stored(fingerprints(df, id_col=id_col, text_col=text_col), "fingerprints")
    groups = kept.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(groups.select("fp")))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp")
    # Only linked fingerprints are named anew. Sides are stored, so that a component of any size, or a fingerprint
    # of very many copies, is a skewed side which a join may split.
    linked = stored(rooted, "linked")
    smallest = stored(linked.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    names = linked.join(smallest, "root").select("fp", F.col("component_id").alias("linked_id"))
    named = stored(groups.join(names, "fp", "left").select("fp", F.coalesce("linked_id", "least").alias("component_id")), "named")
    return kept.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
