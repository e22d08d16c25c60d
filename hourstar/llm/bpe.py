"""Byte-pair encoding with word ends, and its decoding.

A word's symbols form a doubly linked list. A priority queue holds every mergeable pair by merge rank, then
by place; the first entry is merged and its neighbours enter the queue. An entry whose symbols have changed
meanwhile is stale and skipped. So a word of n symbols takes O(n log n) steps. Decoding concatenates the
vocabulary's strings, separated by the decoder's separator.

Words recur, so each worker keeps the ids of short words in a table of bounded size, emptied when full.

What counts as a letter, and which letters have lower case, depends on the Unicode version, and that of the library
that defines the ids is not Python's. So the driver asks the library once for the class of every code point, and texts with
one on which the versions may differ are normalized by the library and split by those classes.

Defined results. Null and empty texts, and texts of white space: no ids, empty decoded text. The strings of
the special tokens inside a text become those tokens, as the file's library does by default. Texts are never
cut; ties and repeated rows are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush
from itertools import chain
from typing import NamedTuple

import pyarrow as pa
import regex
import tokenizers
from pyspark.sql import DataFrame

from hourstar.llm.batches import pieces

KNOWN_WORDS = 200_000
KNOWN_LENGTH = 64


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else the next above 255."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def merge(symbols: Sequence[int], ranks: Mapping[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply the merges ``(left, right) -> (rank, merged)`` in order of rank, then of place."""
    n = len(symbols)
    held: list[int | None] = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    queue = []
    for i in range(n - 1):
        if found := ranks.get((held[i], held[i + 1])):
            queue.append((found[0], i, found[1], held[i], held[i + 1]))
    heapify(queue)
    while queue:
        _, i, merged, left, right = heappop(queue)
        j = after[i]
        if held[i] != left or j >= n or held[j] != right:
            continue  # stale
        held[i], held[j] = merged, None
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if found := ranks.get((merged, held[after[i]])):
                heappush(queue, (found[0], i, found[1], merged, held[after[i]]))
        if (h := before[i]) >= 0 and (found := ranks.get((held[h], merged))):
            heappush(queue, (found[0], h, found[1], held[h], merged))
    return [s for s in held if s is not None]


class BpeFile:
    """Vocabulary, merges and special tokens of a tokenizer's JSON file."""

    def __init__(self, spec: bytes):
        parsed = json.loads(spec)
        model = parsed["model"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = len(model.get("continuing_subword_prefix") or "")
        self.ranks = {
            (self.ids[a], self.ids[b]): (rank, self.ids[a + b[suffix:]]) for rank, (a, b) in enumerate(pairs)
        }
        self.word_end: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        texts = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, texts)) + ")") if texts else None
        self.strings: dict[int, str] = {i: s for s, i in [*self.ids.items(), *self.special.items()]}

    def segments(self, text: str) -> list[str]:
        """Text without special tokens and, at odd places, the special tokens' strings."""
        return self.special_pattern.split(text) if self.special_pattern else [text]


def ranges(points: Iterable[int]) -> str:
    """The inside of a character set that holds the ascending ``points``."""
    out, start, last = [], None, None
    for point in points:
        if start is not None and point == last + 1:
            last = point
            continue
        if start is not None:
            out.append(f"\\U{start:08x}-\\U{last:08x}")
        start = last = point
    if start is not None:
        out.append(f"\\U{start:08x}-\\U{last:08x}")
    return "".join(out)


class Classes(NamedTuple):
    """Character sets: the library's letters, numbers and white space, and what Python may take otherwise."""

    letters: str
    numbers: str
    spaces: str
    doubtful: str


def word_pattern(spec: bytes) -> str:
    """The split that the file states; what it doesn't match is dropped. Other kinds of files are refused."""
    parsed = json.loads(spec)
    normalizer, splitter = parsed["normalizer"] or {}, parsed["pre_tokenizer"] or {}
    steps = [n["type"] for n in normalizer.get("normalizers", [])], [n["type"] for n in splitter.get("pretokenizers", [])]
    if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
        raise ValueError(f"not a file of the word vocabulary's kind: {steps}")
    split = splitter["pretokenizers"][0]
    if split["behavior"] != "Removed" or not split["invert"] or parsed["decoder"] or parsed["post_processor"]:
        raise ValueError("not a file of the word vocabulary's kind")
    return split["pattern"]["Regex"]


@lru_cache(maxsize=2)
def classes(spec: bytes) -> Classes:
    """What the library makes of every code point: all of them go through its splitter in one string.

    A piece is a run of letters, a run of other visible characters, or a single number; which of these, its first
    character tells beside a letter and beside a mark. What lies in no piece is white space.
    """
    splitter = tokenizers.Tokenizer.from_str(spec.decode()).pre_tokenizer
    every = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    letters, numbers, seen = [], [], set()
    for _, (start, end) in splitter.pre_tokenize_str("".join(map(chr, every))):
        run = every[start:end]
        seen.update(run)
        first = chr(run[0])
        if len(splitter.pre_tokenize_str("a" + first)) == 1:
            letters += run
        elif len(splitter.pre_tokenize_str("!" + first)) > 1:
            numbers += run
    spaces = [p for p in every if p not in seen]
    text = "".join(map(chr, every))
    odd = {p for p in every if unicodedata.category(chr(p)) == "Cn"}
    for points, pattern in ((letters, r"\p{L}"), (numbers, r"\p{N}"), (spaces, r"\s")):
        odd |= set(points).symmetric_difference(map(ord, regex.findall(pattern, text)))
    of_library, of_python = tokenizers.normalizers, unicodedata.normalize
    # Beside marks of the first and the last class it shows whether a character is a mark to both.
    for step, own, form in (
        (of_library.Lowercase(), lower, "{}"), (of_library.NFD(), partial(of_python, "NFD"), "{}"),
        (of_library.NFC(), partial(of_python, "NFC"), "\u0345{}"), (of_library.NFC(), partial(of_python, "NFC"), "{}\u0334"),
    ):
        probes = [form.format(chr(p)) for p in every[1:]]
        for probe, found in zip(probes, step.normalize_str("\0".join(probes)).split("\0")):
            if found != own(probe):
                # Together with what it consists of, which may be composed to it.
                odd.update(ord(c) for c in probe + own(probe) + found if c not in "\u0345\u0334")
    return Classes(*map(ranges, (letters, numbers, spaces, sorted(odd))))


def lower(text: str) -> str:
    """Each character in lower case by itself (a sigma at a word's end is an ordinary one)."""
    return text.replace("Σ", "σ").lower()


class WordCodec(dict):
    """Encoder and decoder of the word vocabulary; as a dict, the ids of words seen before."""

    def __init__(self, spec: bytes, sets: Classes):
        super().__init__()
        self.file = BpeFile(spec)
        self.characters = byte_characters()
        pattern = word_pattern(spec)
        self.words = regex.compile(pattern)
        for name, points in ((r"\p{L}", sets.letters), (r"\p{N}", sets.numbers), (r"\s", sets.spaces)):
            pattern = pattern.replace(name, points)
        self.sure_words = re.compile(pattern)
        self.doubtful = re.compile(f"[{sets.doubtful}]")
        below = re.sub(r"\\U(?!0000)\w{8}-\\U\w{8}", "", sets.doubtful)
        self.doubtful_below = re.compile(f"[{below}]")
        self.maybe_doubtful = re.compile(f"[{below}\U00010000-\U0010ffff]")
        self.above = re.compile("[\U00010000-\U0010ffff]+")
        self.normalizer = tokenizers.normalizers.Sequence([tokenizers.normalizers.NFC(), tokenizers.normalizers.Lowercase()])

    def __missing__(self, word: str) -> tuple[int, ...]:
        letters = [self.characters[b] for b in word.encode()]
        letters[-1] += self.file.word_end
        ids = self.file.ids
        found = tuple(merge([ids[s] for s in letters if s in ids], self.file.ranks))
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = found
        return found

    def is_doubtful(self, text: str) -> bool:
        """Whether any character is doubtful. Sets of characters above U+FFFF are slow, so these are looked at by themselves."""
        first = self.maybe_doubtful.search(text)
        if not first:
            return False
        return first[0] < "\U00010000" or bool(self.doubtful.search("".join(self.above.findall(text)))) or bool(
            self.doubtful_below.search(text))

    def split(self, text: str) -> list[str]:
        """The words of the normalized text: NFC, lower case."""
        if text.isascii():
            return self.words.findall(text.lower())
        if self.is_doubtful(text):
            return self.sure_words.findall(self.normalizer.normalize_str(text))
        return self.words.findall(lower(unicodedata.normalize("NFC", text)))

    def encode(self, text: str) -> array:
        out = array("i")
        for k, part in enumerate(self.file.segments(text)):
            if k % 2:
                out.append(self.file.special[part])
            else:
                out.extend(chain.from_iterable(map(self.__getitem__, self.split(part))))
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The vocabulary's strings, one space between; the file names no decoder that would join them otherwise."""
        return " ".join(map(self.file.strings.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(spec: bytes, sets: Classes | None = None) -> WordCodec:
    return WordCodec(spec, sets or classes(spec))


def encode_and_decode(df: DataFrame, spec: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids array<int>, decoded`` of every row; ``spec`` is the content of the tokenizer's JSON file."""
    sets = classes(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec, sets)
        for piece, texts in pieces(batches, 1):
            encoded = [own.encode(t) for t in texts]
            ends = [0, *map(len, encoded)]
            for k in range(1, len(ends)):
                ends[k] += ends[k - 1]
            flat = array("i")
            for ids in encoded:
                flat.extend(ids)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(memoryview(flat), pa.int32()))
            decoded = pa.array([own.decode(ids) for ids in encoded], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column(0), lists, decoded], ["id", "ids", "decoded"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)
