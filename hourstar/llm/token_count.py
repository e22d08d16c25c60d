"""Token counts by a compiled finite-state tokenizer.

A byte-level BPE tokenizer is turned into a deterministic transducer over bytes. After each byte its state
holds every place from which a token may still go on, with the place's last token and its token count
relative to now; the transition is annotated with the change of the count, that is with the tokens emitted
less those taken back by a merge. For words that recur, their bytes' transitions are composed into one. Two neighbouring tokens can stand in an encoding only if they encode to
themselves, and of all tokens that end at a place exactly one can follow what stands before it: that makes
the transducer deterministic. States are compiled when first reached and merged where they are equal.

A text is cut into chunks. A place where white space follows other characters is always a word boundary, so
from there on the state does not depend on what came before. A chunk's state map therefore is: the bytes up to
its first such place, to be read from whatever state comes in; the count between its first and last such
place; and the bytes after the last, which give the state going out. Maps compose associatively; those of a
text are composed by a parallel prefix scan's up-sweep (neighbours first, then pairs of pairs).

Defined results. Null and empty texts: no tokens. The special token's string counts as one token, as the
library does by default. Texts are never cut; repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hourstar.llm.batches import pieces
from hourstar.llm.bpe import BpeFile, byte_characters, merge

# Fixed value: the split of the byte-level vocabulary's file.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

CHUNK = 1 << 15
# Compiled states per worker, about 0.7 KB each; beyond them the table is emptied and compiled anew.
STATES = 400_000
# Words whose transitions are composed, per worker; longer ones are read byte by byte each time.
COMPOSED, COMPOSED_LENGTH = 200_000, 64


class State(dict):
    """Transitions by byte: the next state and the change of the count."""

    __slots__ = ("open", "owner")

    def __init__(self, owner: "Transducer", places: tuple):
        super().__init__()
        self.owner, self.open = owner, places

    def __missing__(self, byte: int) -> tuple["State", int]:
        step = self[byte] = self.owner.step(self, byte)
        return step


class Composed(dict):
    """By word: the composition of its bytes' transitions, from a word's start to the next, as its count."""

    def __init__(self, owner: "Transducer"):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str) -> int:
        count = self.owner.read(word)
        if len(word) <= COMPOSED_LENGTH:
            if len(self) >= COMPOSED:
                self.clear()
            self[word] = count
        return count


class ChunkMap(NamedTuple):
    """``head``: text to be read from the incoming state. If ``synced``: ``count`` tokens follow it, then ``tail``."""

    head: str
    synced: bool = False
    count: int = 0
    tail: str = ""


class Transducer:
    def __init__(self, spec: bytes):
        self.file = BpeFile(spec)
        self.words = regex.compile(BYTE_PATTERN)
        self.first_sync = regex.compile(r"(?<=\S)\s")
        self.last_sync = regex.compile(r"(?r)(?<=\S)\s")
        value = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_of = {i: bytes(value[c] for c in s) for s, i in self.file.ids.items()}
        self.single = [self.file.ids[c] for c in byte_characters()]
        # The vocabulary as a trie: children by (node, byte), the token that ends at a node, nodes with children.
        self.child: dict[tuple[int, int], int] = {}
        self.token: dict[int, int] = {}
        for i, data in self.bytes_of.items():
            node = 0
            for b in data:
                node = self.child.setdefault((node, b), len(self.child) + 1)
            self.token[node] = i
        self.inner = {node for node, _ in self.child}
        self.fits: dict[tuple[int, int], bool] = {}
        self.composed = Composed(self)
        self.reset()

    def reset(self) -> None:
        self.states: dict[tuple, State] = {}
        self.start = State(self, ((0, -1, 0),))

    def neighbours(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when encoded side by side."""
        known = self.fits.get((left, right))
        if known is None:
            both = [self.single[b] for b in self.bytes_of[left] + self.bytes_of[right]]
            known = self.fits[left, right] = merge(both, self.file.ranks) == [left, right]
        return known

    def step(self, state: State, byte: int) -> tuple[State, int]:
        places, chosen = [], None
        # Earlier places first, so longer tokens first; the first that fits is the only one that does.
        for node, last, count in state.open:
            node = self.child.get((node, byte))
            if node is None:
                continue
            token = self.token.get(node)
            if chosen is None and token is not None and (last < 0 or self.neighbours(last, token)):
                chosen = token, count + 1
            if node in self.inner:
                places.append((node, last, count))
        token, change = chosen
        open_ = (*((node, last, count - change) for node, last, count in places), (0, token, 0))
        if len(self.states) >= STATES:
            self.reset()
        found = self.states.get(open_)
        if found is None:
            found = self.states[open_] = State(self, open_)
        return found, change

    def read(self, word: str) -> int:
        state, total = self.start, 0
        for byte in word.encode():
            state, change = state[byte]
            total += change
        return total

    def _words_count(self, text: str) -> int:
        return sum(map(self.composed.__getitem__, self.words.findall(text)))

    def run(self, text: str) -> int:
        """Tokens of a text that begins and ends at word boundaries."""
        parts = self.file.segments(text)
        return len(parts) // 2 + sum(map(self._words_count, parts[::2]))

    def chunk_map(self, chunk: str) -> ChunkMap:
        first = self.first_sync.search(chunk)
        if first is None:
            return ChunkMap(chunk)
        i, j = first.start(), self.last_sync.search(chunk).start()
        return ChunkMap(chunk[:i], True, self.run(chunk[i:j]), chunk[j:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if not a.synced:
            # The seam may be the first boundary of both together.
            seam = a.head + b.head
            if self.first_sync.search(seam) is None:
                return b._replace(head=seam)
            found = self.chunk_map(seam)
            if not b.synced:
                return found
            return ChunkMap(found.head, True, found.count + self.run(found.tail) + b.count, b.tail)
        seam = a.tail + b.head
        if b.synced:
            return ChunkMap(a.head, True, a.count + self.run(seam) + b.count, b.tail)
        j = self.last_sync.search(seam)
        j = j.start() if j else 0
        return ChunkMap(a.head, True, a.count + (self.run(seam[:j]) if j else 0), seam[j:])

    def count(self, text: str, chunk: int = CHUNK) -> int:
        maps = [self.chunk_map(text[k : k + chunk]) for k in range(0, len(text), chunk)]
        while len(maps) > 1:
            paired = [self.compose(*maps[k : k + 2]) for k in range(0, len(maps) - 1, 2)]
            maps = paired + maps[len(paired) * 2 :]
        if not maps:
            return 0
        whole = maps[0]
        return self.run(whole.head) + whole.count + self.run(whole.tail)


@lru_cache(maxsize=2)
def transducer(spec: bytes) -> Transducer:
    return Transducer(spec)


def count_tokens(df: DataFrame, spec: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` of every row; ``spec`` is the content of the tokenizer's JSON file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(spec)
        for piece, texts in pieces(batches, 1):
            columns = [
                piece.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([own.count(t) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
