"""Ranked lexical search: range-maximum tables by posting list bound intervals of documents, searched best first.

Texts become postings of the items' terms in one pass, and those a table in the shared folder with the counts that
scores need. Each task then takes its documents in blocks. A block's posting list is an array of document places in
order with each place's share of a score, and a sparse table of the greatest share in any range. An interval of
places can score no more than the sum of its terms' range maxima. From the whole block on, the intervals of
greatest bound are split at their document of greatest single share, which is scored, until no bound reaches the item's
50th score; that carries over from block to block. Tasks tell 50 documents an item, and those are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridwatch.llm.common import NOT_TERM, Words, id_and_text, map_arrow, materialize, slices

LIMIT = 50
#: Items, and bytes of their texts, that are sought at once: their terms are sent to every task. More are sought in more rounds.
ITEMS, ITEM_BYTES = 2048, 1 << 25
#: Documents of a block, and the postings after which one ends sooner.
BLOCK, BLOCK_POSTINGS = 4096, 1 << 20
#: Intervals that a step splits.
STEP = 96
#: Parts of an item's candidates that are ranked on their own before the last ranking.
SALTS = 64
POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("term", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32()))])
COUNTS = pa.schema([("term", pa.int32()), ("df", pa.int64()), ("total", pa.int64())])
FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def distinct_terms(texts: list) -> list[np.ndarray]:
    """The 64-bit hashes of each text's terms, once each."""
    w = Words(texts, lower=True, space=NOT_TERM)
    h = w.hashes()
    return [np.unique(h[a:b]) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]


def postings(batches: Iterator[pa.RecordBatch], terms: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each text with a term: all its terms counted, and the sought ones (numbers in `terms`) with their counts."""
    for batch, texts in slices(batches):
        w = Words(texts, lower=True, space=NOT_TERM)
        h = w.hashes()
        at = np.searchsorted(terms, h)
        at[at == len(terms)] = 0
        hit = terms[at] == h if len(terms) else np.zeros(len(h), bool)
        key, tf = np.unique(w.doc[hit] * max(1, len(terms)) + at[hit], return_counts=True)
        doc = key // max(1, len(terms))
        some = np.flatnonzero(w.count)
        ends = np.append(np.searchsorted(doc, some), len(doc)).astype(np.int32)
        columns = [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(some)), pa.array(w.count[some], pa.int64())]
        columns += [pa.ListArray.from_arrays(pa.array(ends), pa.array((x).astype(np.int32))) for x in (key - doc * max(1, len(terms)), tf)]
        yield pa.RecordBatch.from_arrays(columns, schema=POSTINGS)


def posting_counts(batches: Iterator[pa.RecordBatch], terms: int) -> Iterator[pa.RecordBatch]:
    """Documents by term; as term -1 the documents, and their terms as its total."""
    df, n, total = np.zeros(terms, np.int64), 0, 0
    for batch in batches:
        df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
        n, total = n + batch.num_rows, total + int(np.sum(batch.column(0).to_numpy()))
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *df[at]], pa.int64()), pa.array([total] + [0] * len(at), pa.int64())], schema=COUNTS)


class Block:
    """Posting lists of a block of documents, end to end, with a sparse table of the place of the greatest share in each range of 2^k."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, term: np.ndarray, tf: np.ndarray, weight: np.ndarray, n: int, total: int):
        held = np.diff(offsets)
        # Like texts side by side, so that an interval's maxima are near its documents' own shares.
        lead = np.zeros(len(ids), np.int64)
        often = np.lexsort((tf, np.repeat(np.arange(len(ids)), held)))
        some = held > 0
        lead[some] = term[often[offsets[1:][some] - 1]]
        order = np.lexsort((sizes, lead))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.docs = ids[order], len(ids)
        doc, m = np.repeat(place, held), np.repeat(50 + (50 * sizes * n) // total, held)
        key = term.astype(np.int64) * self.docs + doc
        by = np.argsort(key, kind="stable")
        self.key = key[by]
        self.share = (weight[term] * ((1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 20 * m)))[by]
        longest = int(np.bincount(term).max(initial=1))
        self.table = [np.arange(len(self.share))]
        for k in range(1, max(1, longest.bit_length())):
            half, last = 1 << (k - 1), self.table[-1]
            a, b = last[: max(0, len(last) - half)], last[half:]
            self.table.append(np.where(self.share[b] > self.share[a], b, a))
        self.level = np.frexp(np.arange(longest + 1))[1] - 1

    def most(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the greatest share in [low, high), the first of equals; -1 for empty ranges."""
        at, size = np.full(low.shape, -1), high - low
        for k in np.unique(self.level[size[size > 0]]):
            own = (size > 0) & (self.level[size] == k)
            a, b = self.table[k][low[own]], self.table[k][high[own] - (1 << k)]
            at[own] = np.where(self.share[b] > self.share[a], b, a)
        return at

    def search(self, terms: np.ndarray, best: tuple[np.ndarray, np.ndarray], limit: int) -> tuple[np.ndarray, np.ndarray]:
        """`best` (scores and ids in order) with this block's documents merged in; bounds below its last score end the search."""
        scores, ids = best
        base = terms.astype(np.int64) * self.docs
        low, high = np.searchsorted(self.key, base)[None], np.searchsorted(self.key, base + self.docs)[None]
        keep = (low < high)[0]
        base, low, high = base[keep], low[:, keep], high[:, keep]
        at = self.most(low, high)
        bound = np.where(at >= 0, self.share[at], 0).sum(axis=1)
        while len(bound):
            if len(scores) == limit:
                open_ = bound >= scores[-1]  # an equal score may have a smaller id
                low, high, at, bound = low[open_], high[open_], at[open_], bound[open_]
            now = np.argpartition(-bound, STEP)[:STEP] if len(bound) > STEP else np.arange(len(bound))
            now = now[bound[now] > 0]
            if not len(now):
                break
            a, b, top, rows = low[now], high[now], at[now], np.arange(len(now))
            share = np.where(top >= 0, self.share[top], -1)
            column = share.argmax(axis=1)
            doc = self.key[top[rows, column]] - base[column]
            cut = np.minimum(np.maximum(np.searchsorted(self.key, base[None, :] + doc[:, None]), a), b)
            here = (cut < b) & (self.key[np.minimum(cut, len(self.key) - 1)] == base[None, :] + doc[:, None])
            told = np.where(here, self.share[np.minimum(cut, len(self.share) - 1)], 0).sum(axis=1)
            scores, ids = ranked(np.concatenate([scores, told]), np.concatenate([ids, self.ids[doc]]), limit)
            rest = np.ones(len(bound), bool)
            rest[now] = False
            new_low, new_high = np.concatenate([a, cut + here]), np.concatenate([cut, b])
            new_at = self.most(new_low, new_high)
            new_bound = np.where(new_at >= 0, self.share[new_at], 0).sum(axis=1)
            some = new_bound > 0
            low, high, at, bound = (np.concatenate([x[rest], y[some]]) for x, y in ((low, new_low), (high, new_high), (at, new_at), (bound, new_bound)))
        return scores, ids


def ranked(scores: np.ndarray, ids: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:limit]
    return scores[order], ids[order]


#: A null id stands after all others.
NO_ID = (1 << 63) - 1


def search_blocks(batches: Iterator[pa.RecordBatch], items: list[np.ndarray], weight: np.ndarray, n: int, total: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Each item's best documents of a task."""
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
    held: list[pa.RecordBatch] = []

    def searched() -> None:
        t = pa.Table.from_batches(held).combine_chunks()
        lists = t["term"].chunk(0) if t.num_rows else pa.array([], pa.list_(pa.int32()))
        offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
        ids = np.where(t["doc_id"].is_null().to_numpy(), NO_ID, t["doc_id"].fill_null(0).to_numpy())
        block = Block(ids, t["n"].to_numpy(), offsets, lists.flatten().to_numpy(), t["tf"].chunk(0).flatten().to_numpy(), weight, n, total)
        for k, terms in enumerate(items):
            best[k] = block.search(terms, best[k], limit)

    docs = entries = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            held.append(part)
            docs, entries = docs + part.num_rows, entries + len(part.column(part.schema.get_field_index("term")).flatten())
            if docs >= BLOCK or entries >= BLOCK_POSTINGS:
                searched()
                held, docs, entries = [], 0, 0
    if docs:
        searched()
    item, score, ids = np.repeat(np.arange(len(items)), [len(s) for s, _ in best]), np.concatenate([s for s, _ in best]), np.concatenate([i for _, i in best])
    some = score > 0
    yield pa.RecordBatch.from_arrays([pa.array(item[some], pa.int32()), pa.array(ids[some], mask=ids[some] == NO_ID), pa.array(score[some], pa.int64())], schema=FOUND)


def _round(texts: DataFrame, rows: list[tuple], limit: int) -> DataFrame:
    spark = texts.sparkSession
    own = distinct_terms([t for _, t in rows])
    terms = np.unique(np.concatenate(own))
    items = [np.searchsorted(terms, x).astype(np.int32) for x in own]
    sought = spark.sparkContext.broadcast(terms)
    posted = materialize(map_arrow(texts, lambda batches: postings(batches, sought.value), "doc_id long, n long, term array<int>, tf array<int>"), "postings")
    size = len(terms)
    counts = map_arrow(posted.select("n", "term"), lambda batches: posting_counts(batches, size), "term int, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total")).toArrow()
    at, df = counts["term"].to_numpy(), counts["df"].to_numpy()
    n, total = (int(np.sum(counts[c].to_numpy()[at < 0])) for c in ("df", "total"))
    weight = np.zeros(size, np.int64)
    for k, d in zip(at[at >= 0].tolist(), df[at >= 0].tolist(), strict=True):
        weight[k] = math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1)))
    told = spark.sparkContext.broadcast((items, weight))
    found = map_arrow(posted, lambda batches: search_blocks(batches, *told.value, n, max(1, total), limit), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= limit).drop("rank")
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= limit)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], "item int, item_id long")
    return last.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, limit: int = LIMIT) -> DataFrame:
    """item_id, rank, doc_id, score: the `limit` documents of greatest score above 0 for each item.

    Terms are runs of letters, digits and characters beyond ASCII, of whole texts, A-Z lower-cased, told apart by 64-bit
    hashes. Equal scores go by ascending doc_id, a null one last. Null and empty texts have no terms and are never
    found; items without terms have no rows. Repeated documents are each ranked; equal rows of `items` count once, and
    an id with several texts has a list for each. Very long texts take time in proportion. Other columns of both tables are
    not read; empty tables give an empty result. About ITEMS items of ITEM_BYTES in all at a time come to the driver and go to the
    tasks; each such round reads the texts again.
    """
    texts = id_and_text(docs).filter("text is not null")
    asked = id_and_text(items, "item_id").filter("text is not null").distinct()
    count, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    rounds = max(-(-count // ITEMS), -(-size // ITEM_BYTES))
    if not rounds:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    # A bucket has ITEMS rows and ITEM_BYTES at most on average.
    dealt = asked.withColumn("round", F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)))
    told = []
    for k in range(rounds):
        rows = [(r.doc_id, r.text.encode()) for r in dealt.filter(F.col("round") == k).orderBy("doc_id", "text").toLocalIterator()]
        if rows:
            told.append(_round(texts, rows, limit))
    return reduce(DataFrame.unionByName, told)
