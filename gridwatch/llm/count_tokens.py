"""Token counts: byte pairs merged by a heap over a linked list; no identifiers are made."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gridwatch.llm.common import batch_of, id_and_text, map_arrow, slices

#: Fixed value: how the vocabulary's library splits a text before merging.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Entries of a worker's cache; it starts anew beyond them.
CACHE = 400_000
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class PairCounter:
    """Counts a text's tokens under the merges of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        number = {s: i for i, s in enumerate(byte_symbols())}
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(told["model"]["merges"]):
            new = number.setdefault(a + b, len(number))
            self.rank[number[a] << 32 | number[b]] = rank
            self.made.append(new)
        special = [t["content"] for t in told["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.marks = special
        self.pieces: dict[str, int] = {}
        self.units: dict[str, int] = {}

    def merges(self, symbols: list[int]) -> int:
        """How often the lowest-rank adjacent pair (the leftmost of equals) can be merged."""
        rank, made, n = self.rank, self.made, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [r << 32 | i for i in range(n - 1) if (r := rank.get(symbols[i] << 32 | symbols[i + 1])) is not None]
        heapq.heapify(heap)
        done = 0
        while heap:
            top = heapq.heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            j = after[i]
            if symbols[i] < 0 or j >= n or rank.get(symbols[i] << 32 | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = made[r], -1
            done += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (q := rank.get(symbols[i] << 32 | symbols[k])) is not None:
                    heapq.heappush(heap, q << 32 | i)
            if (h := before[i]) >= 0 and (q := rank.get(symbols[h] << 32 | symbols[i])) is not None:
                heapq.heappush(heap, q << 32 | h)
        return done

    def piece(self, text: str) -> int:
        n = self.pieces.get(text)
        if n is None:
            symbols = list(text.encode())
            n = len(symbols)
            if n > 1:
                n -= self.merges(symbols)
            if len(text) < 64:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[text] = n
        return n

    def unit(self, text: str) -> int:
        n = sum(map(self.piece, SPLIT.findall(text)))
        if len(text) < 64:
            if len(self.units) >= CACHE:
                self.units.clear()
            self.units[text] = n
        return n

    def plain(self, text: str) -> int:
        """A text without special strings. Cut at single spaces, which a split never spans unless more white space joins them."""
        units = text.replace(" ", "\0 ").split("\0") if "\0" not in text else [" "]
        if any(map(str.isspace, units)):
            return sum(map(self.piece, SPLIT.findall(text)))
        get, total = self.units.get, 0
        for u in units:
            n = get(u)
            total += self.unit(u) if n is None else n
        return total

    def count(self, text: str) -> int:
        if self.special is None or not any(m in text for m in self.marks):
            return self.plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self.plain(p) for p in parts if p)


@lru_cache(maxsize=2)
def counter(path: str) -> PairCounter:
    return PairCounter(path)


def counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        count = counter(path).count
        yield batch_of(
            SCHEMA,
            doc_id=batch.column(0),
            n_bytes=np.array([len(t or b"") for t in texts], np.int64),
            n_tokens=np.array([count(t.decode()) if t else 0 for t in texts], np.int64),
        )


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """A row for each document: doc_id, n_bytes (UTF-8) and n_tokens under the vocabulary file at `path`.

    Equal to the length of what the file's library encodes. One pass without a shuffle; each worker
    keeps a bounded cache of counts. A null text counts as empty and has no tokens; a null id stays null; repeated rows each
    get a row; other columns are not read. Very long words merge in time n log n. An empty table gives an empty result.
    """
    return map_arrow(id_and_text(docs), lambda batches: counted(batches, path), "doc_id long, n_bytes long, n_tokens long")
