"""Substring dedup by automata of repeated phrases.

1. Anchors: of the 25-word phrases in each 50-word window the one of least hash. Equal windows have equal
   anchors, so a phrase that only one text has can't lie in a recurring window.
2. Passages: windows around recurring anchors are counted; those of two documents recur, and belong to the
   document of least id. Adjacent ones form its passages.
3. Automata: a shard holds the passages of some source documents, cut in blocks of 25 words. Every window
   of 50 words holds a whole block. Documents stream through the automata of the shards they need; each
   block found is grown word by word along its passage, and stretches of 50 words or more are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import Words, batch_of, gram_hashes, map_arrow, slices
from gridwatch.llm.lines import NO_ID, keyed

WINDOW = 50
PHRASE = WINDOW // 2
#: A shard has the passages of so many documents on average, and a task so many documents of a hot shard.
SHARD_DOCS, SALT_DOCS = 500, 2000
PASSAGE, TEXT = 0, 1


def slide(x: np.ndarray, width: int, take: np.ufunc) -> np.ndarray:
    """take (minimum or maximum) over each `width` neighbours."""
    span, out = 1, x
    while 2 * span <= width:
        out = take(out[: len(out) - span], out[span:])
        span *= 2
    return take(out[: len(x) - width + 1], out[width - span : len(x) - span + 1])


def anchors(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the phrases that are least in a window."""
    total = len(w.start)
    if total < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = gram_hashes(w.hashes(), PHRASE) | np.uint64(1)
    n = WINDOW - PHRASE + 1
    least = slide(grams, n, np.minimum)
    least[w.doc[: len(least)] != w.doc[WINDOW - 1 :]] = 0  # windows over the edge of a text
    padded = np.concatenate([np.zeros(n - 1, np.uint64), least, np.zeros(n - 1, np.uint64)])
    at = np.flatnonzero(slide(padded, n, np.maximum) == grams)
    return at, grams[at]


def anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("pos", pa.int32())])
    for batch, texts in slices(batches, most=1 << 19):
        w = Words(texts)
        at, h = anchors(w)
        doc = w.doc[at]
        yield batch_of(schema, h=h.view(np.int64), did=batch.column(0).to_numpy()[doc], th=batch.column(1).to_numpy()[doc], pos=(at - w.first[doc]).astype(np.int32))


def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, th, text, anchor positions -> each distinct window of which one is the anchor, where it starts first."""
    schema = pa.schema([("wh", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("start", pa.int32())])
    for batch, texts in slices(batches, most=1 << 19):
        w = Words(texts)
        words = w.hashes()
        grams, phrases = gram_hashes(words, WINDOW), gram_hashes(words, PHRASE) | np.uint64(1)
        own = np.full(len(phrases), ~np.uint64(0))
        for first, found in zip(w.first, batch.column(3).to_pylist(), strict=False):
            p = first + np.array(found, np.int64)
            own[p] = phrases[p]
        n = WINDOW - PHRASE + 1  # a window is wanted if its least phrase is one of those
        least = slide(phrases, n, np.minimum)
        at = np.flatnonzero((slide(own, n, np.minimum) == least) & (w.doc[: len(least)] == w.doc[WINDOW - 1 :]))
        doc = w.doc[at]
        key = np.lexsort((at, grams[at], doc))
        at, doc = at[key], doc[key]
        new = np.append(True, (grams[at][1:] != grams[at][:-1]) | (doc[1:] != doc[:-1]))[: len(at)]
        at, doc = at[new], doc[new]
        yield batch_of(schema, wh=grams[at].view(np.int64), did=batch.column(0).to_numpy()[doc], th=batch.column(1).to_numpy()[doc], start=(at - w.first[doc]).astype(np.int32))


def passage_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, th, text, window starts -> passages: words of adjacent windows, joined by one space."""
    schema = pa.schema([("did", pa.int64()), ("text", pa.string())])
    for batch, texts in slices(batches):
        ids, out = [], []
        for did, text, starts in zip(batch.column(0).to_pylist(), texts, batch.column(3).to_pylist(), strict=True):
            words, s = text.split(), np.unique(np.array(starts, np.int64))
            cut = np.flatnonzero(np.diff(s) > 1) + 1
            for part in np.split(s, cut):
                ids.append(did)
                out.append(b" ".join(words[part[0] : part[-1] + WINDOW]).decode())
        yield batch_of(schema, did=ids, text=out)


class PhraseAutomaton:
    """The blocks of some passages in one automaton; finds where a text repeats the passages.

    Texts are searched as their UTF-8 bytes, one character each, with a space on both sides of every word.
    """

    def __init__(self, passages: list[tuple[int, bytes]]):
        self.source = [d for d, _ in passages]
        w = Words([t for _, t in passages])
        self.hash, self.first = w.hashes(), w.first
        self.trie = ahocorasick.Automaton()
        for k, (_, text) in enumerate(passages):
            words = text.split()
            for at in range(0, len(words) - PHRASE + 1, PHRASE):
                block = (b" " + b" ".join(words[at : at + PHRASE]) + b" ").decode("latin-1")
                if block in self.trie:
                    self.trie.get(block).append((k, at))
                else:
                    self.trie.add_word(block, [(k, at)])
        self.trie.make_automaton()

    def covered(self, did: int, text: bytes) -> list[int]:
        """Word ranges (from, to, ...) that repeat 50 words or more of a passage of a lesser document."""
        if not len(self.trie):
            return []
        w = Words([text])
        own = w.hashes()
        joined = b" " + b" ".join(text.split()) + b" "
        ends = np.cumsum(w.end - w.start + 1) + 1  # of each word with the space behind it, in `joined`
        done: dict[tuple[int, int], int] = {}
        out: list[int] = []
        for last, blocks in self.trie.iter(joined.decode("latin-1")):
            to = int(np.searchsorted(ends, last + 1)) + 1
            for k, at in blocks:
                lane = (k, to - at)
                if self.source[k] >= did or done.get(lane, -1) >= to:
                    continue
                low, high = self.first[k], self.first[k + 1]
                left, right = low + at, low + at + PHRASE  # in the passages' words
                start = to - PHRASE
                back = min(start, left - low)
                same = own[start - back : start][::-1] == self.hash[left - back : left][::-1]
                back = back if same.all() else int(np.argmin(same))
                on = min(len(own) - to, high - right)
                same = own[to : to + on] == self.hash[right : right + on]
                on = on if same.all() else int(np.argmin(same))
                done[lane] = to + on
                if PHRASE + back + on >= WINDOW:
                    out += [start - back, to + on]
        return out


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of shard, salt and kind: a shard's passages come first, then its documents stream through."""
    schema = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("ranges", pa.list_(pa.int32()))])
    key, passages, automaton = None, [], None
    for batch, texts in slices(batches, most=1 << 22):
        dids, ths, found = [], [], []
        columns = [batch.column(i).to_pylist() for i in range(5)]
        for shard, salt, kind, did, th, text in zip(*columns, texts, strict=True):
            if key != (shard, salt):
                key, passages, automaton = (shard, salt), [], None
            if kind == PASSAGE:
                passages.append((did, text))
                continue
            if automaton is None:
                automaton = PhraseAutomaton(passages)
            if ranges := automaton.covered(did, text):
                dids.append(did)
                ths.append(th)
                found.append(ranges)
        yield batch_of(schema, did=dids, th=ths, ranges=found)


def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """did, th, text, ranges, whether it copies a lesser document's text -> what stays."""
    schema = pa.schema([("did", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    for batch, texts in slices(batches):
        counts, gone, out = [], [], []
        for text, ranges, copy in zip(texts, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            words = (text or b"").split()
            counts.append(len(words))
            if copy and len(words) >= WINDOW:
                kept = []
            elif ranges:
                mark = np.zeros(len(words) + 1, np.int32)
                np.add.at(mark, ranges[0::2], 1)
                np.add.at(mark, ranges[1::2], -1)
                kept = [x for x, c in zip(words, np.cumsum(mark).tolist(), strict=False) if not c]
            else:
                kept = words
            gone.append(len(words) - len(kept))
            out.append(b" ".join(kept).decode())
        yield batch_of(schema, did=batch.column(0), n_words=counts, n_removed=gone, kept=out)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """A row for each document: doc_id, n_words, n_removed, kept (words that stay, joined by one space).

    A word goes if a window of 50 consecutive words around it also starts in a document of lesser doc_id,
    as the documents came in. A null text has no words. A null doc_id counts as the least one. Rows of the
    same doc_id never remove each other's words. Texts with fewer than 50 words stay whole. Only documents with a window that recurs
    by hash are streamed against passages, which loses none. A whole copy of an earlier document's text is known by the text's
    64-bit hash and goes as a whole if it has 50 words. Repeated rows get equal results. Very long texts take time and memory in proportion to their length, a text at a time.
    Other columns are not read; an empty table gives an empty result.
    """
    rows = keyed(docs)
    n_docs = docs.count()
    shards = max(1, -(-n_docs // SHARD_DOCS))
    texts = rows.groupBy("th").agg(F.min("did").alias("first"))  # equal texts: the least document stands for all
    post = map_arrow(rows, anchor_rows, "h long, did long, th long, pos int")
    recurring = post.groupBy("h").agg(F.min("th").alias("a"), F.max("th").alias("b")).filter("a <> b").select("h")
    found = post.select("h", "th", "pos").join(recurring, "h").groupBy("th").agg(F.collect_set("pos").alias("pos"))
    found = found.join(texts, "th").select(F.col("first").alias("did"), "th", "pos")
    windows = map_arrow(rows.join(found, ["did", "th"]).select("did", "th", "text", "pos"), window_rows, "wh long, did long, th long, start int")
    repeated = windows.groupBy("wh").agg(F.min("did").alias("source"), F.max("did").alias("other")).filter("source <> other").select("wh", "source")
    owned = windows.join(repeated, "wh")

    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    sources = owned.filter("did = source").groupBy("did", "th").agg(F.collect_list("start").alias("starts"))
    passages = map_arrow(rows.join(sources, ["did", "th"]).select("did", "th", "text", "starts"), passage_rows, "did long, text string")
    targets = owned.filter("source < did").select("did", "th", shard("source").alias("shard")).distinct()
    salts = targets.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / SALT_DOCS).cast("int").alias("salts"))
    build = passages.withColumn("shard", shard("did")).join(salts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(PASSAGE).alias("kind"), "did", F.lit(0).cast("long").alias("th"), "text")
    salted = targets.join(salts, "shard").select("did", "th", "shard", F.pmod(F.xxhash64("did", "th"), F.col("salts")).cast("int").alias("salt"))
    stream = rows.join(salted, ["did", "th"]).select("shard", "salt", F.lit(TEXT).alias("kind"), "did", "th", "text")
    dealt = build.unionByName(stream).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
    ranges = map_arrow(dealt, search, "did long, th long, ranges array<int>").groupBy("did", "th").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    copies = rows.select("did", "th").join(texts, "th").filter("did > first").select("did", "th", F.lit(True).alias("copy")).distinct()
    marked = ranges.join(copies, ["did", "th"], "full")
    whole = rows.join(marked, ["did", "th"], "left").select("did", "th", "text", "ranges", F.coalesce("copy", F.lit(False)).alias("copy"))
    out = map_arrow(whole, removed, "did long, n_words long, n_removed long, kept string")
    return out.select(F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")
