"""Sum-of-squares online packing of token sequences into windows.

Every document becomes token ids and one closing id. Full windows are cut off it; the rest goes, as it
comes, to a partly filled window. ``SquaredLevels`` holds how many windows stand at each fill level. A
rest of size s goes to the level h (0: a new window) for which the sum of the squared counts of all
partly filled levels becomes least; ties go to the fuller window. What is still partly filled when a
partition ends is closed by free cuts: the emptiest windows fill up the fullest ones, and the last one
is cut into windows whose lengths are powers of two. So no window needs padding.

A partition of the scan is packed where it is read: no shuffle, and memory holds only the windows that
are partly filled. A retried task reads the same rows in the same order and makes the same windows.

Defined cases: null and empty text are one closing id; repeated rows are packed once each; an empty
table gives no rows; other columns have no effect.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from anonkit.llm.common import pa_schema, quiet_tokenizers, tokenizer_path
from anonkit.llm.token_counts import RankMerger

_MEMO_PIECES = 250_000
_PLAIN_BELOW = 0x250  # Latin letters up to here are composed already, and lower case is a matter of each alone
_WINDOWS_PER_PARTITION = 1 << 40
_LETTER, _NUMBER, _SIGN, _OTHER = range(4)


def _plain_characters() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point below ``_PLAIN_BELOW``; the last entry stands for all others.

    Apostrophes are no plain signs, as some pre-tokens begin with one.
    """
    kinds = np.full(_PLAIN_BELOW + 1, _OTHER, np.int8)
    lower = np.arange(_PLAIN_BELOW + 1, dtype=np.uint32)
    for point in range(_PLAIN_BELOW):
        sign, low = chr(point), chr(point).lower()
        if not sign.isprintable() or sign.isspace() or sign == "'" or len(low) > 1 or ord(low) >= 0x800:
            continue
        lower[point] = ord(low)
        kinds[point] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(low)[0], _SIGN)
    return kinds, lower


class PieceTokenizer:
    """Ids of whole texts as the tokenizer library gives them, for vocabularies that drop white space.

    White space only parts pre-tokens, so a text's ids are those of its pieces between spaces, one after
    another, and a bounded memo holds the ids of each distinct piece. Pieces of plain Latin text are cut into
    pre-tokens and merged in bulk, as normalization does nothing but lower their case; all others go through the library.
    """

    def __init__(self, path: str, memo_pieces: int = _MEMO_PIECES):
        quiet_tokenizers()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            self.merger = RankMerger.from_model(json.load(source)["model"])
        self.kinds, self.lower = _plain_characters()
        self.memo_pieces = memo_pieces
        self._forget()

    def _forget(self) -> None:
        # a piece that is new takes the next number
        self.place: defaultdict[str, int] = defaultdict(count(1).__next__, {"": 0})
        self.ids = Growing(np.int32)
        self.start, self.length = Growing(np.int64, 1), Growing(np.int64, 1)

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces, in the order of their numbers."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4")
        begin = np.cumsum(size) - size
        kind = self.kinds[np.minimum(points, _PLAIN_BELOW)]
        special = np.zeros(len(points), bool)  # "<|" may begin a special token, wherever pieces meet
        special[:-1] = (points[:-1] == ord("<")) & (points[1:] == ord("|"))
        other = np.logical_or.reduceat((kind == _OTHER) | special, begin)
        length, start = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        plain = np.flatnonzero(~other)
        if len(plain):
            mine = np.repeat(~other, size)
            length[plain], ids = self._merged(self.lower[points[mine]], kind[mine], np.repeat(np.arange(len(plain)), size[plain]))
            start[plain] = len(self.ids) + np.cumsum(length[plain]) - length[plain]
            self.ids.extend(ids)
        rest = np.flatnonzero(other)
        if len(rest):
            made = [e.ids for e in self.library.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)]
            length[rest] = [len(i) for i in made]
            start[rest] = len(self.ids) + np.cumsum(length[rest]) - length[rest]
            self.ids.extend(np.array([i for one in made for i in one], np.int32))
        self.start.extend(start)
        self.length.extend(length)

    def _merged(self, points: np.ndarray, kind: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each piece, and the ids; pre-tokens are runs of letters or of signs, and single numbers."""
        fresh = np.ones(len(points), bool)
        fresh[1:] = (piece[1:] != piece[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        first = np.flatnonzero(fresh)
        two = points >= 0x80
        at = np.arange(len(points)) + np.cumsum(two) - two
        data = np.empty(len(points) + int(two.sum()), np.uint8)
        data[at] = np.where(two, 0xC0 | (points >> 6), points)
        data[at[two] + 1] = 0x80 | (points[two] & 0x3F)
        length, ids = self.merger.merge_flat(data, np.add.reduceat(1 + two.astype(np.int64), first), with_ids=True)
        return np.bincount(piece[first], length, piece[-1] + 1).astype(np.int64), ids

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.place) > self.memo_pieces:
            self._forget()
        known = len(self.place)
        rows = []
        for text in texts:
            row = (text or "").replace("\n", " ").split(" ")
            rows.append(np.fromiter(map(self.place.__getitem__, row), np.int64, len(row)))
        if fresh := list(islice(reversed(self.place), len(self.place) - known)):
            self._learn(fresh[::-1])
        ids, start, length = self.ids.values(), self.start.values(), self.length.values()
        return [ragged(ids, start, length, row) for row in rows]


class Growing:
    """An array that grows at its end; its space doubles, so that growing costs no more than filling."""

    def __init__(self, kind: type, size: int = 0):
        self.size, self.space = size, np.zeros(max(1024, size), kind)

    def __len__(self) -> int:
        return self.size

    def extend(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.space):
            space = np.zeros(max(need, 2 * len(self.space)), self.space.dtype)
            space[: self.size] = self.space[: self.size]
            self.space = space
        self.space[self.size : need] = more
        self.size = need

    def values(self) -> np.ndarray:
        return self.space[: self.size]


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The given rows of a ragged array, one after the other."""
    sizes = length[rows]
    shift = np.repeat(start[rows] - np.cumsum(sizes) + sizes, sizes)
    return flat[shift + np.arange(len(shift))]


class SquaredLevels:
    """Counts of partly filled windows by fill level, and the windows that stand there."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.windows: list[list[list]] = [[] for _ in range(capacity)]

    def best_level(self, size: int) -> int:
        """Level whose use makes the sum of squares least; 0 opens a window.

        From h to h+s the sum changes by 2*(N[h+s] - N[h]) + 2, without the N[h+s] part for a full window
        and without the N[h] part for a new one.
        """
        top = self.capacity - size
        if top <= 0:
            return 0
        change = 2 * (self.count[size : self.capacity + 1] - self.count[: top + 1]) + 2
        change[0] = 2 * self.count[size] + 1
        change[top] = 1 - 2 * self.count[top]  # the window becomes full and leaves the sum
        usable = self.count[: top + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def place(self, size: int, piece: object) -> list | None:
        """Add a piece; returns the window's pieces if it is now full."""
        if size == self.capacity:
            return [piece]
        level = self.best_level(size)
        pieces = []
        if level:
            self.count[level] -= 1
            pieces = self.windows[level].pop()
        pieces.append(piece)
        if level + size == self.capacity:
            return pieces
        self.count[level + size] += 1
        self.windows[level + size].append(pieces)
        return None

    def drain(self) -> list[list]:
        """All partly filled windows, the fullest first."""
        left = [window for level in reversed(self.windows) for window in level]
        self.__init__(self.capacity)
        return left


class Piece:
    """Ids ``start`` to ``start + len(ids)`` of one document."""

    __slots__ = ("ids", "key", "start", "total")

    def __init__(self, key: object, start: int, ids: np.ndarray, total: int):
        self.key, self.start, self.ids, self.total = key, start, ids, total

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.key, self.start, self.ids[:at], self.total),
            Piece(self.key, self.start + at, self.ids[at:], self.total),
        )


def close_windows(windows: list[list[Piece]], capacity: int) -> Iterator[list[Piece]]:
    """Fill the fullest windows from the emptiest; the last is cut into powers of two."""
    filled = [sum(len(p.ids) for p in w) for w in windows]
    low, high = 0, len(windows) - 1
    while low < high:
        room = capacity - filled[low]
        piece = windows[high].pop()
        if len(piece.ids) > room:
            piece, rest = piece.cut(room)
            windows[high].append(rest)
        windows[low].append(piece)
        filled[low] += len(piece.ids)
        filled[high] -= len(piece.ids)
        if filled[low] == capacity:
            yield windows[low]
            low += 1
        if not filled[high]:
            high -= 1
    if low == high and filled[low]:
        rest = windows[low][::-1]
        left = filled[low]
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                piece = rest.pop()
                if len(piece.ids) > room:
                    piece, later = piece.cut(room)
                    rest.append(later)
                window.append(piece)
                room -= len(piece.ids)
            yield window


def pack(documents: Iterator[tuple[object, np.ndarray]], capacity: int) -> Iterator[list[Piece]]:
    """Windows of at most ``capacity`` ids, each full or a power of two long."""
    levels = SquaredLevels(capacity)
    for key, ids in documents:
        piece = Piece(key, 0, ids, len(ids))
        while len(piece.ids) > capacity:
            full, piece = piece.cut(capacity)
            yield [full]
        if window := levels.place(len(piece.ids), piece):
            yield window
    yield from close_windows(levels.drain(), capacity)


@cache
def own_tokenizer(path: str) -> PieceTokenizer:
    """That of this worker process, with its memo."""
    return PieceTokenizer(path)


def pack_documents(
    df: DataFrame,
    key: str,
    text: str,
    *,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
    slice_rows: int = 500,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence; ``with_ids`` adds its token ids."""
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + (", ids array<int>" if with_ids else "")
    )
    target = pa_schema(schema)

    def documents(batches: Iterator[pa.RecordBatch], encoder: PieceTokenizer) -> Iterator[tuple[object, np.ndarray]]:
        end = np.array([end_id], np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                ids = encoder.encode(part.column(text).to_pylist())
                yield from ((k, np.concatenate([i, end])) for k, i in zip(part.column(key).to_pylist(), ids, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = own_tokenizer(tokenizer_path(tokenizer))
        sequence = TaskContext.get().partitionId() * _WINDOWS_PER_PARTITION
        rows: list[tuple] = []
        for window in pack(documents(batches, encoder), capacity):
            offset = 0
            for p in window:
                crc = zlib.crc32(p.ids.astype("<u4").tobytes())
                row = (p.key, p.start, len(p.ids), crc, p.total, sequence, offset)
                rows.append((*row, p.ids) if with_ids else row)
                offset += len(p.ids)
            sequence += 1
            if len(rows) >= 4096:
                yield as_batch(rows)
                rows = []
        if rows:
            yield as_batch(rows)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), target, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.select(key, text).mapInArrow(run, schema)
