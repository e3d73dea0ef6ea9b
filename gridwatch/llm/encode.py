"""BPE encoding and decoding by last-token states on a trie of distinct words.

The encoding of a prefix is fixed by its last token: the one token that ends there and that stays apart
from the last token before it when the two are merged alone. So a walk down the trie finds the last
token of every prefix once, and each word's tokens are read off by stepping back token by token.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import batch_of, id_and_text, map_arrow, slices
from gridwatch.llm.count_tokens import byte_symbols

#: Fixed value: the words of a chunk, as the vocabulary file tells.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Characters that str.split() takes for white space and the vocabulary's library does not.
CONTROL = regex.compile(r"[\x1c-\x1f]")
WORD_END = "</w>"
#: Entries of a task's caches: chunks (two generations of so many and of a part's own), pairs of tokens, steps of the suffix automaton.
CHUNKS, PAIRS, STEPS = 150_000, 500_000, 500_000
#: Longer chunks are not kept for long.
LONGEST = 64
NEVER = 1 << 40
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
DDL = "doc_id long, n_tokens long, ids binary, decoded string"


class Vocabulary:
    """A tokenizers file with word ends: tokens, merges and how each token comes about.

    A word's symbols are one character each: its bytes, the last one moved up by 256.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        ids, letter = told["model"]["vocab"], byte_symbols()
        self.marks = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in told["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.marks, key=len, reverse=True))) + ")")
        names = {i: s for s, i in ids.items()} | {t["id"]: t["content"] for t in told["added_tokens"]}
        self.names = pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string())
        #: Id of each token that merging its own symbols gives, by its symbols.
        self.told = {chr(k): ids[s] for b, s in enumerate(letter) for k, s in ((b, s), (b + 256, s + WORD_END))}
        #: When a token is made (the rank of its last merge; -1: a symbol), and of what.
        self.when, self.left, self.right = {i: -1 for i in self.told.values()}, {}, {}
        self.rank: dict[int, int] = {}
        spelt = {i: s for s, i in self.told.items()}
        for rank, (x, y) in enumerate(told["model"]["merges"]):
            self.rank[ids[x] << 20 | ids[y]] = rank
        for rank, (x, y) in enumerate(told["model"]["merges"]):
            a, b, new = ids[x], ids[y], ids[x + y]
            if new in self.when or a not in self.when or b not in self.when or not self.apart(a, b, rank):
                continue
            if max(self.when[a], self.when[b]) >= rank:
                raise ValueError(f"merge {rank} comes before those of its parts")
            self.when[new], self.left[new], self.right[new] = rank, a, b
            spelt[new] = spelt[a] + spelt[b]
            self.told[spelt[new]] = new
        #: All beginnings of tokens.
        self.heads = {s[:k] for s in self.told for k in range(1, len(s) + 1)}

    def apart(self, a: int, b: int, own: int = -1) -> bool:
        """Whether merging leaves tokens a and b side by side (but for the rule of rank `own`).

        Undoes the merges at the border, the latest first. A rule across the border must come up before
        the parts beside it go into larger ones; of equal ranks the leftmost pair is merged first.
        """
        until_a = until_b = NEVER
        while True:
            q = self.rank.get(a << 20 | b, NEVER)
            if q != own and q < until_a and q <= until_b and q < NEVER:
                return False
            if self.when[a] > self.when[b]:
                until_a, a = self.when[a], self.right[a]
            elif self.when[b] >= 0:
                until_b, b = self.when[b], self.left[b]
            else:
                return True

    def decode(self, ids: list[bytes]) -> pa.Array:
        """Texts of packed ids (little-endian unsigned 32 bits): their tokens, joined by one space. A null has a null text."""
        ends = np.append(0, np.cumsum(np.fromiter((len(i or b"") // 4 for i in ids), np.int64, len(ids))))
        tokens = self.names.take(pa.array(np.frombuffer(b"".join(i or b"" for i in ids), "<u4")))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), tokens), " ")
        return pc.if_else(pa.array([i is not None for i in ids], pa.bool_()), texts, pa.scalar(None, pa.string()))


class TrieEncoder:
    """Encodes texts under a vocabulary; its caches are a task's own and bounded."""

    def __init__(self, vocabulary: Vocabulary, chunks: int = CHUNKS):
        self.v, self.most = vocabulary, chunks
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.fits: dict[int, bool] = {}
        #: The suffix automaton as far as it was walked: the longest beginning of a token at the end of a path.
        self.state = {"": 0}
        self.spelt, self.ends, self.steps = [""], [()], {}

    def step(self, state: int, symbol: int) -> tuple[int, tuple]:
        """The state after one more symbol, and the tokens that end there with their sizes, the longest first."""
        s = self.spelt[state] + chr(symbol)
        while s not in self.v.heads:
            s = s[1:]
        new = self.state.setdefault(s, len(self.spelt))
        if new == len(self.spelt):
            self.spelt.append(s)
            self.ends.append(tuple((self.v.told[s[k:]], len(s) - k) for k in range(len(s)) if s[k:] in self.v.told))
        if len(self.steps) >= STEPS:
            self.steps.clear()
        told = self.steps[state << 9 | symbol] = (new, self.ends[new])
        return told

    def fitting(self, before: int, token: int) -> bool:
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        told = self.fits[before << 20 | token] = self.v.apart(before, token)
        return told

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of distinct words. Sorted, they are the trie's leaves as a depth-first walk meets them.

        What a word shares with the one before it is the part of the walk's path that stays, with its last
        tokens; each symbol after that is a new node. Memory is that of one path.
        """
        steps, fits, out = self.steps, self.fits, {}
        path, states, tokens, sizes = b"", [0], [0], [0]
        for word in sorted(words):
            s = word.encode()
            n, k = len(s), 0
            for x, y in zip(path, s):
                if x != y:
                    break
                k += 1
            path, k = s, min(k, len(path) - 1, n - 1) if path else 0  # a last symbol is like no other
            del states[k + 1 :], tokens[k + 1 :], sizes[k + 1 :]
            state, symbols = states[k], list(s)
            symbols[-1] += 256
            for d in range(k, n):
                c = symbols[d]
                state, ends = steps.get(state << 9 | c) or self.step(state, c)
                for token, size in ends:
                    at = d + 1 - size
                    if not at:
                        break
                    ok = fits.get(tokens[at] << 20 | token)
                    if ok or ok is None and self.fitting(tokens[at], token):
                        break
                states.append(state)
                tokens.append(token)
                sizes.append(size)
            found, at = array("I"), n
            while at:
                found.append(tokens[at])
                at -= sizes[at]
            found.reverse()
            out[word] = found.tobytes()
        return out

    @staticmethod
    def words_of(chunk: str) -> list[str]:
        if not chunk.isascii():
            return SPLIT.findall("".join(map(str.lower, unicodedata.normalize("NFC", chunk))))
        return [chunk.lower()] if chunk.isalpha() else SPLIT.findall(chunk.lower())

    def add(self, chunks: set[str]) -> None:
        """Have the ids of all these chunks in `young`: from before, special strings, and the words of all others by one walk."""
        young, old, marks, new, needed = self.young, self.old, self.v.marks, [], set()
        for c in chunks.difference(young):
            ids = old.get(c)
            if ids is None:
                ids = marks.get(c)
            if ids is None:
                words = self.words_of(c)
                new.append((c, words))
                needed.update(words)
            else:
                young[c] = ids
        # A word of ASCII is a chunk as well.
        known = {w: ids for w in needed if (ids := young.get(w) or old.get(w)) is not None and w.isascii()}
        known |= self.learn(needed.difference(known))
        young |= {w: ids for w, ids in known.items() if w.isascii()}
        for c, words in new:
            young[c] = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])

    def cut(self, text: str) -> list[str]:
        """Chunks between white space; special strings stand alone."""
        if "<|" in text and self.v.special.search(text):
            return [c for i, part in enumerate(self.v.special.split(text)) for c in ([part] if i % 2 else self.cut_plain(part))]
        return self.cut_plain(text)

    @staticmethod
    def cut_plain(text: str) -> list[str]:
        return [c for c in regex.split(r"\s+", text) if c] if CONTROL.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids, as little-endian unsigned 32 bits."""
        cut = [self.cut(t) for t in texts]
        self.add(set().union(*cut))
        ids = [b"".join(map(self.young.__getitem__, chunks)) for chunks in cut]
        if len(self.young) > self.most:
            self.old, self.young = {c: x for c, x in self.young.items() if len(c) <= LONGEST}, {}
        return ids


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """One for a worker; only its caches are a task's own."""
    return Vocabulary(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = TrieEncoder(vocabulary(path))
    for batch, texts in slices(batches):
        ids = coder.encode([(t or b"").decode() for t in texts])
        yield batch_of(SCHEMA, doc_id=batch.column(0), n_tokens=[len(i) // 4 for i in ids], ids=ids, decoded=coder.v.decode(ids))


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """A row for each document: doc_id, n_tokens, ids (packed little-endian unsigned 32-bit) and decoded text.

    Ids are those of the vocabulary file's library, without begin and end tokens; the text is decoded from
    them. One pass without a shuffle; a part of about 1 MB of text at a time shares a trie, and a task's
    bounded cache carries chunks over to the next. Memory grows with a text's length, not its square. A
    null text counts as empty: no ids, an empty decoded text. A null doc_id stays null. Repeated rows each
    get a row; other columns are not read. An empty table gives an empty result.
    """
    return map_arrow(id_and_text(docs), lambda batches: encoded(batches, path), DDL)


def bpe_decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """A row for each of `rows` (doc_id, packed ids): doc_id, decoded. Null ids have a null text, none an empty one."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in slices(batches, "ids"):
            yield batch_of(schema, doc_id=batch.column(0), decoded=vocabulary(path).decode(ids))

    return map_arrow(rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("binary").alias("ids")), decoded, "doc_id long, decoded string")
