"""SentencePiece encoding and decoding by suffix-array matching.

Encoding. Spaces become the piece alphabet's space mark, and a text falls into words: a
run of marks and the characters up to the next mark (no piece reaches over a word's
end). The distinct words of a slice that the task has not met are laid end to end, and
the places in that text are sorted by the characters that follow (prefix doubling, up to
the longest piece). Binary search over the sorted places, one character at a time for
all pieces at once, gives the range of places where each piece occurs; each occurrence
is an edge from its start to its end. Edges are sorted by the position of their end in
the word and relaxed in that order, for all words at once: an edge holds if its piece
may follow the last piece of the encoding of the word up to the edge's start. Of a
byte-pair vocabulary exactly one edge into each reachable place holds, so walking back
from a word's end gives its pieces. Characters that no piece covers become the pieces
of their bytes.

Two pieces may follow each other if merging, in the order of the pieces' scores, would
never join across their border; that is decided by undoing the last merges on either
side of the border, latest first (``Vocabulary.may_follow``).

Decoding joins pieces and bytes, turns marks into spaces and drops the leading one.

Nulls: a null text gives null ids; an empty one no ids. Null ids give a null text.
Repeated rows are encoded alike. A space mark in a text decodes as a space, which is
the vocabulary's own loss. Columns other than id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirframe.llm.batches import kept_in_worker, mix, slices, starts_of

MARK = "▁"
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Distinct words whose pieces a task remembers.
REMEMBERED = 300_000
#: Slots of the table of pairs whose fit a task remembers.
PAIR_BITS = 20


@dataclass
class Vocabulary:
    """Pieces that text can form, with the merges that form them."""

    pieces: list[str]
    ids: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    decoded: list[bytes]
    size: int

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        text, byte_ids, decoded = {}, np.zeros(256, np.int64), [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                decoded[i] = bytes([int(piece[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text[piece] = (model.get_score(i), i)
                decoded[i] = piece.replace(MARK, " ").encode()
        # Higher scores merge first; rank 0 is the first merge.
        order = sorted(text, key=lambda piece: (-text[piece][0], text[piece][1]))
        scores: dict[float, int] = {}
        for piece in order:
            scores.setdefault(text[piece][0], len(scores))
        number, last = {}, {}
        for piece in sorted(text, key=lambda p: (len(p), text[p][1])):
            merge = _last_merge(piece, text)
            if merge is not None:
                number[piece] = len(number)
                last[piece] = merge
        pieces = list(number)
        left = np.array([number[last[p][0]] for p in pieces], np.int64)
        right = np.array([number[last[p][1]] for p in pieces], np.int64)
        found = {}
        for piece, at in number.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    found[a * len(pieces) + b] = at
        codes = np.array(sorted(found), np.int64)
        return Vocabulary(
            pieces,
            np.array([text[p][1] for p in pieces], np.int64),
            np.array([-1 if len(p) == 1 else scores[text[p][0]] for p in pieces], np.int64),
            left, right, codes, np.array([found[code] for code in codes.tolist()], np.int64),
            byte_ids, decoded, size,
        )

    def may_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece ``b`` may stand right of piece ``a``, for arrays of piece numbers."""
        a, b = a.copy(), b.copy()
        fits = np.ones(len(a), bool)
        # Merges from this time on are undone. Equal ranks: the left merge comes first.
        limit = np.full(len(a), 2 * len(self.pieces) + 10, np.int64)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            code = x * len(self.pieces) + y
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            joins = (self.pairs[at] == code) & (2 * self.rank[self.merged[at]] + 1 < limit[live])
            fits[live[joins]] = False
            rank_x, rank_y = 2 * self.rank[x], 2 * self.rank[y] + 2
            single = (self.rank[x] < 0) & (self.rank[y] < 0)
            stay = ~joins & ~single
            undo_x = (rank_x > rank_y) | (self.rank[y] < 0)
            undo_x &= self.rank[x] >= 0
            take = live[stay & undo_x]
            limit[take] = 2 * self.rank[a[take]] + 1
            a[take] = self.right[a[take]]
            take = live[stay & ~undo_x]
            limit[take] = 2 * self.rank[b[take]] + 2
            b[take] = self.left[b[take]]
            live = live[stay]
        return fits


def _last_merge(piece: str, text: dict[str, tuple[float, int]]) -> tuple[str, str] | None:
    """The two parts joined last when merging forms ``piece``; none if merging never does."""
    parts, merge = list(piece), (piece, piece)
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            known = text.get(parts[k] + parts[k + 1])
            if known is not None and (best is None or known[0] > best):
                best, at = known[0], k
        if at < 0:
            return None
        merge = (parts[at], parts[at + 1])
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return merge


def _behind(values: np.ndarray, span: int) -> np.ndarray:
    """The value ``span`` places on; zero behind the end."""
    found = np.zeros_like(values)
    found[:-span] = values[span:]
    return found


def suffix_order(codes: np.ndarray, reach: int) -> np.ndarray:
    """Places of ``codes`` sorted by the ``reach`` codes that follow each (prefix doubling).

    The first sort takes as many codes at once as fit a key of 63 bits.
    """
    letters = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
    letters[codes] = 1
    rank = np.cumsum(letters)[codes]
    bits, span = int(letters.sum()).bit_length(), 1
    key = rank
    while span < reach and 2 * span * bits < 64:
        key = (key << (span * bits)) | _behind(key, span)
        span *= 2
    order = np.argsort(key)
    if span < reach:
        step = np.concatenate([[1], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty_like(key)
        rank[order] = np.cumsum(step)
    while span < reach:
        key = rank * (int(rank.max()) + 1) + _behind(rank, span)
        order = np.argsort(key)
        step = np.concatenate([[1], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(step)
        span *= 2
    return order


def occurrences(codes: np.ndarray, order: np.ndarray, wanted: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Range of ``order`` whose places begin with each wanted string (rows, padded)."""
    low = np.zeros(len(wanted), np.int64)
    high = np.full(len(wanted), len(order), np.int64)
    padded = np.concatenate([codes, np.full(wanted.shape[1], -1, codes.dtype)])
    for depth in range(wanted.shape[1]):
        rows = np.flatnonzero((sizes > depth) & (low < high))
        if not len(rows):
            break
        goal = wanted[rows, depth]
        for side in (0, 1):
            # The first place in the range whose code at this depth is (above) the goal.
            a, b = low[rows].copy(), high[rows].copy()
            while True:
                open_rows = a < b
                if not open_rows.any():
                    break
                middle = (a + b) // 2
                found = padded[order[np.minimum(middle, len(order) - 1)] + depth]
                less = (found <= goal) if side else (found < goal)
                a = np.where(open_rows & less, middle + 1, a)
                b = np.where(open_rows & ~less, middle, b)
            if side == 0:
                first = a
            else:
                low[rows], high[rows] = first, a
    return low, high


class Encoder:
    """Pieces of texts, with the pieces of words remembered."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.longest = max(map(len, vocabulary.pieces))
        self.sizes = np.fromiter(map(len, vocabulary.pieces), np.int64, len(vocabulary.pieces))
        self.wanted = np.full((len(self.sizes), self.longest), -2, np.int32)
        for row, piece in enumerate(vocabulary.pieces):
            self.wanted[row, : len(piece)] = np.frombuffer(piece.encode("utf-32-le"), np.int32)
        self.pair_code = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]

    def _follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * len(self.sizes) + b
        slot = (mix(code) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        missing = np.flatnonzero(self.pair_code[slot] != code)
        fits = self.pair_fits[slot]
        if len(missing):
            new, place = np.unique(code[missing], return_inverse=True)
            known = self.vocabulary.may_follow(new // len(self.sizes), new % len(self.sizes))
            fits[missing] = known[place]
            at = (mix(new) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
            self.pair_code[at], self.pair_fits[at] = new, known
            # Two new pairs may share a slot; the later one stays, with its own answer.
            self.pair_fits[at] = known[np.searchsorted(new, self.pair_code[at])]
        return fits

    def _segment(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        joined = "\0".join(words) + "\0"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32)
        word_sizes = np.fromiter(map(len, words), np.int64, len(words))
        begin = starts_of(word_sizes + 1)[:-1]
        order = suffix_order(codes, self.longest)
        low, high = occurrences(codes, order, self.wanted, self.sizes)
        per_piece = high - low
        ends = starts_of(per_piece)
        start = order[np.repeat(low - ends[:-1], per_piece) + np.arange(ends[-1])]
        piece = np.repeat(np.arange(len(per_piece)), per_piece)
        # A character without a piece of its own is an edge of its own kind.
        within = np.ones(len(codes), bool)
        within[begin + word_sizes] = False
        covered = np.zeros(len(codes), bool)
        covered[start[self.sizes[piece] == 1]] = True
        alone = np.flatnonzero(within & ~covered)
        start, piece = np.concatenate([start, alone]), np.concatenate([piece, np.full(len(alone), -1)])
        inside = within[start]
        start, piece = start[inside], piece[inside]
        size = np.where(piece < 0, 1, self.sizes[piece])
        depth = start + size - np.repeat(begin, word_sizes + 1)[start]
        # Numpy sorts 16-bit numbers by radix.
        small = int(depth.max(initial=0)) < 1 << 16
        by_end = np.argsort(depth.astype(np.uint16) if small else depth, kind="stable")
        start, piece, size, depth = start[by_end], piece[by_end], size[by_end], depth[by_end]
        borders = np.searchsorted(depth, np.arange(1, int(word_sizes.max(initial=0)) + 2))
        # The last piece of the encoding up to each place (behind a place's character); -2: none.
        last = np.full(len(codes) + 1, -2, np.int64)
        first = np.zeros(len(codes) + 1, bool)
        first[begin] = True
        for k in range(len(borders) - 1):
            at = slice(borders[k], borders[k + 1])
            s, p = start[at], piece[at]
            before = np.where(first[s], -3, last[s])
            holds = before != -2
            pair = np.flatnonzero((before >= 0) & (p >= 0))
            holds[pair] = self._follows(before[pair], p[pair])
            to = (s + size[at])[holds]
            last[to] = np.where(p[holds] < 0, -1, p[holds])
        return self._walk(codes, begin, word_sizes, last)

    def _walk(self, codes, begin, word_sizes, last) -> tuple[np.ndarray, np.ndarray]:
        """Back from each word's end along the pieces that hold, for all words at once."""
        at, live = begin + word_sizes, np.arange(len(begin))
        live = live[word_sizes > 0]
        words, places, found = [], [], []
        while len(live):
            piece = last[at[live]]
            if (piece == -2).any():
                raise ValueError("a word has no encoding")
            step = np.where(piece < 0, 1, self.sizes[piece])
            at[live] -= step
            words.append(live)
            places.append(at[live])
            found.append(piece)
            live = live[at[live] > begin[live]]
        if not words:
            return np.zeros(0, np.int32), np.zeros(len(begin), np.int64)
        slot = np.full(len(codes), -1, np.int64)
        found = np.concatenate(found)
        slot[np.concatenate(places)] = np.arange(len(found))
        place = np.flatnonzero(slot >= 0)
        word, piece = np.concatenate(words)[slot[place]], found[slot[place]]
        ids, owner = self.vocabulary.ids[piece].astype(np.int32), word
        unknown = np.flatnonzero(piece < 0)
        if len(unknown):
            spelled = [
                self.vocabulary.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in codes[place[unknown]]
            ]
            more = np.ones(len(ids), np.int64)
            more[unknown] = [len(one) for one in spelled]
            borders = starts_of(more)
            ids, owner = np.repeat(ids, more), np.repeat(owner, more)
            target = np.repeat(borders[unknown], more[unknown]) + np.concatenate([np.arange(len(s)) for s in spelled])
            ids[target] = np.concatenate(spelled)
        return ids, np.bincount(owner, minlength=len(begin))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [WORDS.findall((MARK + text).replace(" ", MARK)) if text else [] for text in texts]
        words = [word for parts in split for word in parts]
        distinct = set(words)
        new = list(distinct.difference(self.number))
        if len(self.number) + len(new) > REMEMBERED:
            self._forget()
            new = list(distinct)
        if new:
            ids, counts = self._segment(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            self.ids.append(ids)
            self.counts.append(counts)
        all_ids, all_counts = np.concatenate(self.ids), np.concatenate(self.counts)
        first = starts_of(all_counts)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        sizes, ends = all_counts[numbers], starts_of(all_counts[numbers])
        flat = all_ids[np.repeat(first[numbers] - ends[:-1], sizes) + np.arange(ends[-1])]
        borders = ends[starts_of(np.fromiter(map(len, split), np.int64, len(split)))]
        return [flat[borders[k] : borders[k + 1]] for k in range(len(texts))]


def decode(ids: np.ndarray, decoded: list[bytes]) -> str:
    text = b"".join(map(decoded.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text.removeprefix(" ")


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids``, their number and CRC-32, and whether they decode to the text, of every row."""
    vocabulary = Vocabulary.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(f"pieces {model_path}", lambda: Encoder(vocabulary))
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts = part.column("text").to_pylist()
                found = encoder.encode([text or "" for text in texts])
                known = [ids if text is not None else None for ids, text in zip(found, texts, strict=True)]
                columns = [
                    part.column("doc_id"),
                    pa.array(known, pa.list_(pa.int32())),
                    pa.array([None if ids is None else len(ids) for ids in known], pa.int64()),
                    pa.array([None if ids is None else zlib.crc32(ids.astype("<u4").tobytes()) for ids in known], pa.int64()),
                    pa.array(
                        [
                            None if ids is None else decode(ids, vocabulary.decoded) == text
                            for ids, text in zip(known, texts, strict=True)
                        ],
                        pa.bool_(),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_ids", "ids_crc32", "round_trip"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, ids_crc32 long, round_trip boolean")


def decode_table(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``text`` of every row's ids; null ids give a null text, none an empty one."""
    vocabulary = Vocabulary.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode(np.array(ids, np.int64), vocabulary.decoded) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    source = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return source.mapInArrow(run, "doc_id long, text string")
