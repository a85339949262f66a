"""Packing token ids into windows by minimum bin slack.

A document is its token ids and one end id. It is cut into whole windows and a rest;
rests wait in a pool that each task keeps for its own rows, so nothing is shuffled.
Windows are filled from the pool: the longest rest goes in first, and a bitset
subset-sum program over the other lengths (bit ``s`` of a big integer is set when ``s``
tokens can be filled) finds the multiset that comes closest to the capacity. Walking
back over the stored bitsets gives the number of rests of each length. Where no multiset
fits exactly, the longest rest left is cut to fill the gap. What remains at the end of a
task, less than one window, is cut into sequences whose lengths are powers of two, which
need no padding.

Ids are those of the tokenizer for the whole text. Each distinct word is encoded once
and looked up from then on (see ``ChunkEncoder``).

Nulls: a null text is empty, a null id stays null. An empty document is its end id
alone. Repeated rows are packed each. Columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import repeat
from operator import is_not

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import kept_in_worker, returning, slices, starts_of, strings

CAPACITY = 2048
END_ID = 1
#: Rests that wait before windows are filled, and that stay for better fits afterwards.
POOL, KEPT = 6000, 2000
#: Distinct words whose ids a task remembers.
REMEMBERED = 600_000
#: Marks behind a word that never share a token with it, and the key under which their own ids are kept.
MARKS = ".,;:!?)*#$%&|<>"
MARK_KEY = "\0 "
#: Words that are encoded in one call.
JOINED = 1000
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def gather(values: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[k] : starts[k + 1]]`` of all ``k`` in ``rows``, end to end."""
    sizes = starts[rows + 1] - starts[rows]
    ends = starts_of(sizes)
    return values[np.repeat(starts[rows] - ends[:-1], sizes) + np.arange(ends[-1])]


class ChunkEncoder:
    """Token ids of texts, with the ids of words remembered.

    A text is split at its spaces. The tokenizer's pattern splits there as well, and
    gives the space to the word behind it, where the space stands alone between two
    characters that are not white space. Other texts are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # In a byte-level vocabulary every character of a token stands for one byte.
        size = self.tokenizer.get_vocab_size()
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.odd = np.zeros(0, bool)
        self.uses = np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Forget words, the least used first, until half as many are left."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: REMEMBERED // 2])
        words = list(self.number)
        self.ids = gather(self.ids, starts_of(self.sizes), keep)
        self.sizes, self.odd, self.uses = self.sizes[keep], self.odd[keep], self.uses[keep] // 2
        self.number = {words[at]: k for k, at in enumerate(keep.tolist())}

    def _learn(self, words: set[str]) -> None:
        if len(self.number) > REMEMBERED:
            self._thin()
        new = list(words.difference(self.number))
        if not new:
            return
        stems = list(map(str.rstrip, new, repeat(MARKS)))
        # A word and the marks behind it are tokens of their own: encode the word once.
        marked = [k for k, (word, stem) in enumerate(zip(new, stems, strict=True)) if word is not stem and stem.isalpha()]
        if marked:
            self._learn_plain(list({stems[k] for k in marked}.difference(self.number)))
            behind = [new[k][len(stems[k]) :] for k in marked]
            self._learn_plain(list({MARK_KEY + marks for marks in behind}.difference(self.number)))
            at = np.array([(self.number[stems[k]], self.number[MARK_KEY + marks]) for k, marks in zip(marked, behind, strict=True)])
            ids = gather(self.ids, starts_of(self.sizes), at.ravel())
            self._add([new[k] for k in marked], ids, self.sizes[at].sum(axis=1), np.zeros(len(marked), bool))
            new = list(words.difference(self.number))
        self._learn_plain(new)

    def _learn_plain(self, new: list[str]) -> None:
        if not new:
            return
        if new[0].startswith(MARK_KEY):
            found = [np.array(one.ids, np.uint32) for one in self._batch([word[len(MARK_KEY) :] for word in new])]
            self._add(new, np.concatenate(found), np.array([len(ids) for ids in found]), np.zeros(len(new), bool))
            return
        odd = np.fromiter(map(is_not, map(str.strip, new), new), bool, len(new))
        odd |= np.fromiter(map(len, new), np.int64, len(new)) == 0
        plain = ["" if bad else word for word, bad in zip(new, odd.tolist(), strict=True)] if odd.any() else new
        runs = [" ".join(["", *filter(None, plain[at : at + JOINED])]) for at in range(0, len(plain), JOINED)]
        found = [np.array(one.ids, np.uint32) for one in self._batch(runs)]
        flat = np.concatenate(found)
        # A token's place in the joined words follows from the bytes before it.
        taken = np.fromiter(map(len, map(str.encode, plain)), np.int64, len(plain))
        ends = np.cumsum(taken + (taken > 0))
        borders = np.searchsorted(np.cumsum(self.bytes_of[flat]), ends, side="right")
        self._add(new, flat, np.diff(borders, prepend=0), odd)

    def _add(self, words: list[str], ids: np.ndarray, sizes: np.ndarray, odd: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, ids])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.odd = np.concatenate([self.odd, odd])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])

    def _batch(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [[""] if self._marked(text) else text.split(" ") for text in texts]
        words = [word for parts in split for word in parts[1:]]
        self._learn(set(words))
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        flat = gather(self.ids, starts_of(self.sizes), numbers)
        ends = starts_of(self.sizes[numbers])
        words_before = starts_of(np.fromiter(map(len, split), np.int64, len(split)) - 1)
        odd_before = starts_of(self.odd[numbers])
        whole = odd_before[words_before[1:]] > odd_before[words_before[:-1]]
        heads = self._batch(
            [
                text if odd or self._marked(text) else parts[0]
                for text, odd, parts in zip(texts, whole.tolist(), split, strict=True)
            ]
        )
        borders = ends[words_before]
        return [
            np.array(head.ids, np.uint32)
            if whole[k]
            else np.concatenate([np.array(head.ids, np.uint32), flat[borders[k] : borders[k + 1]]])
            for k, head in enumerate(heads)
        ]

    def _marked(self, text: str) -> bool:
        return any(token in text for token in self.special)


def fill(pool: dict[int, list], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """Lengths and how often each is taken, so that their sum comes closest to ``room``.

    ``lengths`` are the keys of ``pool`` in rising order.
    """
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[k]
        steps.append((length, reach))
        for _ in range(min(len(pool[length]), room // length)):
            grown = (reach | reach << length) & full
            if grown == reach:
                break
            reach = grown
        if reach >> room & 1:
            break
    best = reach.bit_length() - 1
    taken = []
    for length, before in reversed(steps):
        used = 0
        while not before >> best & 1:
            best -= length
            used += 1
        if used:
            taken.append((length, used))
    return taken


class Packer:
    """Pieces of one task: ``add`` documents, then ``rest``; both yield rows of the result."""

    def __init__(self, capacity: int, first_sequence: int) -> None:
        self.capacity = capacity
        self.sequence = first_sequence
        self.pool: dict[int, list[tuple]] = {}
        self.lengths: list[int] = []
        self.waiting = 0

    def _place(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            yield doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def _wait(self, piece: tuple) -> None:
        length = len(piece[2])
        if not length:
            return
        if length not in self.pool:
            self.pool[length] = []
            insort(self.lengths, length)
        self.pool[length].append(piece)
        self.waiting += 1

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
            del self.lengths[bisect_left(self.lengths, length)]
        self.waiting -= 1
        return piece

    def _cut(self, room: int) -> tuple:
        """A piece of at most ``room`` tokens from the longest rest; what is left waits on."""
        doc_id, start, ids, total = self._take(self.lengths[-1])
        self._wait((doc_id, start + room, ids[room:], total))
        return doc_id, start, ids[:room], total

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total = len(ids)
        whole = total - total % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._place([(doc_id, start, ids[start : start + self.capacity], total)])
        self._wait((doc_id, whole, ids[whole:].copy(), total))
        if self.waiting >= POOL:
            yield from self._pack(KEPT)

    def _pack(self, keep: int) -> Iterator[tuple]:
        tokens = sum(length * len(pieces) for length, pieces in self.pool.items())
        while self.waiting > keep and tokens >= self.capacity:
            window = [self._take(self.lengths[-1])]
            room = self.capacity - len(window[0][2])
            for length, used in fill(self.pool, self.lengths, room):
                window += [self._take(length) for _ in range(used)]
                room -= length * used
            while room:
                window.append(self._cut(room))
                room -= len(window[-1][2])
            tokens -= self.capacity
            yield from self._place(window)

    def rest(self) -> Iterator[tuple]:
        yield from self._pack(0)
        left = sum(length * len(pieces) for length, pieces in self.pool.items())
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                window.append(self._cut(room))
                room -= len(window[-1][2])
            yield from self._place(window)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it comes from, its ids' CRC-32, its sequence and offset there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = kept_in_worker(f"encoder {tokenizer_path}", lambda: ChunkEncoder(tokenizer_path))
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        for batch in returning(batches):
            for part in slices(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                rows = [
                    row
                    for doc_id, tokens in zip(ids, encoder.encode(strings(part, "text")), strict=True)
                    for row in packer.add(doc_id, np.append(tokens, np.uint32(end_id)).astype("<u4"))
                ]
                yield _table(rows)
        yield _table(list(packer.rest()))

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, SCHEMA)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)
