"""Token counts by rank-synchronous array merging.

Pre-tokens of many texts lie in one flat array of symbols with row offsets (a ragged array). In each
round every sequence finds the lowest rank among its adjacent pairs and merges all places that have
it, for all sequences at once. A sequence that has no pair left leaves the array, and its number of
symbols is its count. As a merge of symbols always ranks behind the merges that made them, merging all
places of one rank at once gives what merging them one by one gives.

Equal pieces between spaces are counted once per worker: a bounded memo holds their counts.

Defined cases: null and empty text have 0 tokens; strings of special tokens inside a text count as one
token each, as in the library's default; row order, repeated rows and other columns have no effect.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from anonkit.llm.common import map_rows, tokenizer_path

# Fixed value: the pattern of byte-level pre-tokens.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_NO_RANK = np.int64(1) << 40
_MEMO_PIECES = 500_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    stands = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stands[b] for b in range(256)]


class PairTable:
    """(left id, right id) -> (rank, merged id) in an open-addressing table that numpy probes in bulk."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NO_RANK, np.int64)
        self.merged = np.zeros(1 << bits, np.int64)
        keys = self.key(left, right)
        slot, open_rows = self.slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(open_rows):
            self.probes += 1
            free = open_rows[self.keys[slot[open_rows]] == -1]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]] = keys[placed]
            self.ranks[slot[placed]] = placed
            self.merged[slot[placed]] = merged[placed]
            open_rows = np.setdiff1d(open_rows, placed, assume_unique=True)
            slot[open_rows] = (slot[open_rows] + 1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 24) | right.astype(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, -1 if it is no merge."""
        keys = self.key(left, right)
        slot = self.slot(keys)
        found = np.full(len(keys), -1, np.int64)
        rows = np.arange(len(keys))
        for _ in range(self.probes):
            here = self.keys[slot]
            hit = here == keys[rows]
            found[rows[hit]] = slot[hit]
            more = ~hit & (here != -1)
            if not more.any():
                break
            rows, slot = rows[more], (slot[more] + 1) & self.mask
        return found


class RankMerger:
    """Byte-pair merges of many sequences at once; ``suffix`` marks the last symbol of a sequence."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        left, right, merged = (
            np.array([vocab[f(a, b)] for a, b in merges], np.int64)
            for f in (lambda a, b: a, lambda a, b: b, lambda a, b: a + b)
        )
        self.pairs = PairTable(left, right, merged)
        self.first = np.array([vocab[s] for s in byte_symbols()], np.int64)
        self.final = np.array([vocab[s + suffix] for s in byte_symbols()], np.int64)

    @classmethod
    def from_model(cls, model: dict) -> RankMerger:
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        return cls(model["vocab"], merges, model.get("end_of_word_suffix") or "")

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols that survive in each piece."""
        return self.merge(pieces)[0]

    def merge(self, pieces: list[bytes], with_ids: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols of each piece: their number and, one piece after the other, their ids."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return self.merge_flat(np.frombuffer(b"".join(pieces), np.uint8), length, with_ids)

    def merge_flat(self, data: np.ndarray, length: np.ndarray, with_ids: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces whose bytes lie one after the other, with the length of each."""
        out = np.zeros(len(length), np.int64)
        row = np.flatnonzero(length)
        done_flat: list[np.ndarray] = []
        done_row: list[np.ndarray] = []
        flat, length = self.first[data], length[row]
        last = np.cumsum(length) - 1
        flat[last] = self.final[data[last]]
        while len(row):
            start = np.zeros(len(row), np.int64)
            np.cumsum(length[:-1], out=start[1:])
            slot = np.full(len(flat), -1, np.int64)
            slot[:-1] = self.pairs.find(flat[:-1], flat[1:])
            slot[start + length - 1] = -1  # the last symbol has no right neighbour in its own sequence
            rank = np.where(slot >= 0, self.pairs.ranks[slot], _NO_RANK)
            lowest = np.minimum.reduceat(rank, start)
            done = lowest == _NO_RANK
            if done.any():
                out[row[done]] = length[done]
                stays = np.repeat(~done, length)
                if with_ids:
                    done_flat.append(flat[~stays])
                    done_row.append(np.repeat(row[done], length[done]))
                flat, rank, slot, lowest = flat[stays], rank[stays], slot[stays], lowest[~done]
                row, length = row[~done], length[~done]
                if not len(row):
                    break
                start = np.cumsum(length) - length
            place = np.flatnonzero((rank == np.repeat(lowest, length)) & (rank < _NO_RANK))
            fresh = np.ones(len(place), bool)
            fresh[1:] = place[1:] != place[:-1] + 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - run) % 2 == 0]  # of overlapping places, from the left
            flat[place] = self.pairs.merged[slot[place]]
            keep = np.ones(len(flat), bool)
            keep[place + 1] = False
            length = np.add.reduceat(keep.astype(np.int64), start)
            flat = flat[keep]
        if not with_ids or not done_flat:
            return out, np.zeros(0, np.int64)
        return out, np.concatenate(done_flat)[np.argsort(np.concatenate(done_row), kind="stable")]


class TextCounter:
    """Tokens of whole texts, as the tokenizer file defines them."""

    def __init__(self, path: str, memo_pieces: int = _MEMO_PIECES):
        import regex

        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        self.merger = RankMerger.from_model(model["model"])
        self.pre_token = regex.compile(PRE_TOKEN)
        special = [t["content"] for t in model["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.memo_pieces = memo_pieces
        self.bare: dict[str, int] = {}
        self.spaced: dict[str, int] = {}  # the same piece behind one space

    def _fill(self, memo: dict[str, int], pieces: list[str], prefix: str) -> None:
        special = np.zeros(len(pieces), np.int64)
        words: list[str] = []
        owner: list[int] = []
        for i, piece in enumerate(pieces):
            if piece.isalpha():
                words.append(prefix + piece)
                owner.append(i)
                continue
            parts = [prefix + piece]
            if self.special and "<" in piece:
                parts = self.special.split(parts[0])
                special[i] = len(parts) - 1
            for part in parts:
                found = self.pre_token.findall(part)
                words += found
                owner += [i] * len(found)
        total = special + np.bincount(owner, self.merger.counts([w.encode() for w in words]), len(pieces)).astype(np.int64)
        memo.update(zip(pieces, total.tolist(), strict=True))

    def _sums(self, memo: dict[str, int], prefix: str, rows: list[list[str]]) -> list[int]:
        """Sum of the counts of each row's pieces; the memo is emptied when it is full."""
        if len(memo) > self.memo_pieces:
            memo.clear()
        missing: set[str] = set()
        for row in rows:
            missing.update(filterfalse(memo.__contains__, row))
        if missing:
            self._fill(memo, list(missing), prefix)
        return [sum(map(memo.__getitem__, row)) for row in rows]

    def counts(self, texts: list[str | None]) -> list[int]:
        """White space never joins what stands before it to what follows, so a piece counts the same in any text.

        Splitting at single spaces is right if no run of white space is cut in two; other texts are split
        into runs of white space with the word behind.
        """
        bare, spaced = [], []
        for text in texts:
            if not text:
                continue
            pieces = text.split(" ")
            if "" in pieces or "\n \n" in text or not text.replace("\n", "").isprintable():
                pieces = re.findall(r"\s*\S+|\s+", text)
                bare.append([p for p in pieces if p[0] != " "])
                spaced.append([p[1:] for p in pieces if p[0] == " "])
            else:
                bare.append(pieces[:1])
                spaced.append(pieces[1:])
        sums = map(sum, zip(self._sums(self.bare, "", bare), self._sums(self.spaced, " ", spaced), strict=True))
        return [next(sums) if text else 0 for text in texts]


@cache
def own_counter(path: str) -> TextCounter:
    """That of this worker process, with its memo."""
    return TextCounter(path)


def count_tokens(
    df: DataFrame, key: str, text: str, *, tokenizer: str = "byte_bpe_50k.json", limit: int = 512, slice_rows: int = 500
) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text. A projection: no shuffle."""

    def work(keys: pa.Array, texts: pa.Array) -> dict[str, object]:
        counter = own_counter(tokenizer_path(tokenizer))
        values = texts.to_pylist()
        n = [c for i in range(0, len(values), slice_rows) for c in counter.counts(values[i : i + slice_rows])]
        size = [len(t.encode()) if t else 0 for t in values]
        return {key: keys, "n_bytes": size, "n_tokens": n, "over_limit": [c > limit for c in n]}

    kind = df.schema[key].dataType.simpleString()
    return map_rows(df, [key, text], work, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
