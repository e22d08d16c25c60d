"""Grouping of spelling variants: words that differ by one inserted, deleted or replaced character.

Near words are found by scanning sorted word lists. For one word the rows of the edit matrix against the list's words are
kept by depth; only the band around the diagonal matters, three cells. Adjacent words of the list share a prefix, and the rows
of that prefix are reused. Where all cells of a row exceed one edit, every following word that shares the prefix
is skipped.

The vocabulary is not scanned as one list. Let ``L`` be the shorter length of a pair and ``p`` the length of its common
prefix, 0 to L: there the one edit lies. A pair belongs to the half of the places 0..L that holds p, and to one list only: the
list of the words with the same ``L``, the same characters before that half and the same ones behind it. The list of a half
with more than ``LIST`` words is dealt by quarters, and so on; a list for a single place holds words that differ in one or
two characters there, no more than the alphabet allows. So every list is bounded, however many words begin or end alike, and no
pair is lost or found twice. Lists for an early half are sorted from the words' ends, where they share most.

Words are counted per task before the shuffle. A word's form is its most frequent near word, if that is at least
``RATIO`` times as frequent; forms are followed to the last, the root, by doubling.

Defined results. Null and empty texts have no words. A null id counts as the empty string. Rows with repeated ids and texts count
again. Ties: smallest form in code-point order. Empty tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourstar.llm.batches import pieces
from hourstar.session import shuffle_partitions, stored

LEAST_LENGTH, LEAST_COUNT = 6, 5
RATIO = 5
DAMAGED = 199
LIST = 512  # words of a list that is dealt no further
HELD = 200_000  # distinct words a task counts before it passes them on
ROWS_PER_TASK = 200_000  # words of lists

# Fixed value: letters a word is made of. A-Z become lower-case beforehand.
_RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(text: str, doc_id: object) -> Counter:
    """The words of a text with their counts, damaged ones included."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    found: Counter = Counter()
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
        mixed = zlib.crc32(run.encode(), start)
        if mixed % DAMAGED == 0:
            at = mixed % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def vocabulary(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least LEAST_LENGTH characters that occur at least LEAST_COUNT times."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for piece, texts in pieces(batches, 1):
            for doc_id, text in zip(piece.column(0).to_pylist(), texts):
                for word, n in words_of(text, doc_id).items():
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
                if len(held) >= HELD:
                    yield batch()
                    held.clear()
        yield batch()

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    counted = rows.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def near_in_list(word: str, others: list[str], shared: list[int]) -> Iterator[int]:
    """Places of the words in a sorted list at a distance of one. ``shared[i]`` is the common prefix of i - 1 and i."""
    size = len(word)
    padded = word + "\0\0"  # no letter
    # rows[d] holds the cells d-1, d, d+1 of the row for d characters of the list's word, 2 standing for more than one edit.
    rows = [(2, 0, 1)]
    dead = None  # the length of a prefix that exceeds one edit
    for i, other in enumerate(others):
        depth = shared[i]
        if dead is not None:
            if depth >= dead:
                continue
            dead = None
        del rows[depth + 1 :]
        left, middle, right = rows[-1]
        for d in range(depth, len(other)):
            letter = other[d]
            if d > size:
                dead = d + 1
                break
            low = left + (letter != padded[d - 1])
            if middle + 1 < low:
                low = middle + 1
            new = middle + (letter != padded[d])
            if right + 1 < new:
                new = right + 1
            if low + 1 < new:
                new = low + 1
            high = right + (letter != padded[d + 1])
            if new + 1 < high:
                high = new + 1
            if low > 1 and new > 1 and high > 1:
                dead = d + 1
                break
            left, middle, right = low, new, high
            rows.append((low, new, high))
        else:
            gap = size - len(other)
            if -1 <= gap <= 1 and rows[-1][1 + gap] == 1:
                yield i


def near_pairs(members: list[tuple[str, int]], length: int, low: int, high: int, backward: bool) -> Iterator[tuple[str, int, str, int]]:
    """``a, n of a, b, n of b`` for the pairs of a list: a has ``length`` characters, b as many or one more; the common prefix
    is ``low`` to ``high`` - 1 characters long. Sorted from the end if ``backward``."""
    turned = sorted((w[::-1] if backward else w, n) for w, n in members)
    others = [w for w, _ in turned]
    shared = [0] * len(others)
    for i in range(1, len(others)):
        a, b = others[i - 1], others[i]
        most, k = min(len(a), len(b)), 0
        while k < most and a[k] == b[k]:
            k += 1
        shared[i] = k
    for i, (word, n) in enumerate(turned):
        if len(word) != length:
            continue
        for j in near_in_list(word, others, shared):
            other = others[j]
            if len(other) < length or len(other) == length and j < i:
                continue
            a, b = (word[::-1], other[::-1]) if backward else (word, other)
            prefix = next((k for k in range(length) if a[k] != b[k]), length)
            if low <= prefix < high:
                yield a, n, b, turned[j][1]


def _keyed(words: DataFrame) -> DataFrame:
    """Adds the list's key: its shorter length, the places, the characters before and behind them."""
    behind = F.expr("right(word, greatest(shorter + 1 - high, 1) - 1)")
    return words.withColumn("key", F.concat_ws(
        "\n", F.col("shorter"), F.col("low"), F.col("high"), F.expr("left(word, low)"), F.when(F.col("high") <= F.col("shorter"), behind).otherwise("")
    ))


def _halved(words: DataFrame) -> DataFrame:
    """Each word once for either half of its places."""
    middle = F.expr("(low + high) div 2").cast("int")
    halves = F.array(F.struct("low", middle.alias("high")), F.struct(middle.alias("low"), "high"))
    return _keyed(words.select("word", "n", "shorter", F.explode(halves).alias("half")).select("word", "n", "shorter", "half.low", "half.high"))


def word_lists(words: DataFrame) -> DataFrame:
    """``key, shorter, low, high, word, n``: the lists, none with more than LIST words but those for a single place."""
    sizes = F.filter(F.array(F.length("word"), F.length("word") - 1), lambda s: s >= LEAST_LENGTH)
    whole = words.select("word", "n", F.explode(sizes).alias("shorter")).withColumn("low", F.lit(0)).withColumn("high", F.col("shorter") + 1)
    left, done = _halved(whole), None
    while True:
        left = stored(left, "lists")
        large = stored(left.where("high - low > 1").groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > LIST).select("key"), "large")
        if large.isEmpty():
            return left if done is None else done.unionByName(left)
        small = left.join(large, "key", "left_anti")
        done = small if done is None else done.unionByName(small)
        left = _halved(left.join(large, "key", "left_semi").drop("key"))


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of near words of ``word, n`` once."""
    lists = word_lists(words)
    tasks = max(shuffle_partitions(words.sparkSession), -(-lists.count() // ROWS_PER_TASK))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, shape, members, found = None, None, [], []

        def pairs() -> None:
            if len(members) > 1:
                shorter, low, high = shape
                # The later a half, the more the list's words share in front.
                found.extend(near_pairs(members, shorter, low, high, low < shorter + 1 - high))

        def batch() -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 4
            kinds = pa.string(), pa.int64(), pa.string(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["a", "a_n", "b", "b_n"])

        for rows in batches:
            for row in zip(*(c.to_pylist() for c in rows.columns)):
                if row[0] != key:
                    pairs()
                    key, shape, members = row[0], row[1:4], []
                members.append(row[4:6])
                if len(found) >= 50_000:
                    yield batch()
                    found.clear()
        pairs()
        yield batch()

    dealt = lists.select("key", "shorter", "low", "high", "word", "n").repartition(tasks, "key").sortWithinPartitions("key")
    return dealt.mapInArrow(scan, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every row of ``word, form``: forms followed to the last.

    Each round doubles the steps; counts grow RATIO-fold by step, so a handful of rounds do.
    """
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = reached.select(F.col("word").alias("root"), F.col("root").alias("top"))
        further = stored(reached.join(above, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "roots")
        reached = further.select("word", "root")
        if further.where("moved").isEmpty():
            return reached


def spelling_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word."""
    words = stored(vocabulary(docs, id_col=id_col, text_col=text_col), "vocabulary")
    pairs = stored(near_words(words), "near")
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    joined = words.join(best, "word", "left").withColumn("form_n", -F.col("best.n"))
    frequent = F.col("form_n") >= RATIO * F.col("n")
    named = stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n"),
    ), "forms")
    return named.join(roots(named.where("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))
