"""LM scoring: corpus word counts for the base, and causal self-attention on subword ids for the model.

The model is one of classes: from the subword ids before it, attention tells the class of the subword that begins
the next word (or the end), and the corpus shares the class out among its words, add one. So what it knows
beyond the base is what attention sees. Counts are over all training rows, and attention weights are trained
on all of them, in tasks whose weights are averaged.
"""

from __future__ import annotations

import json
import math
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm import attention as A
from gridwatch.llm.common import Words, batch_of, crc_mod, map_arrow, materialize, mix, slices
from gridwatch.llm.count_tokens import byte_symbols
from gridwatch.llm.lines import NO_ID, keyed

FOLDS, HELD_OUT = 7, 2
#: Words whose counts are broadcast (16 bytes each); all others are looked up by a join.
HEAD_WORDS = 50_000
#: Training rows of the first round, about; later rounds take more, the last one all that are left.
FIRST_DOCS = 2000
#: Rows that a task of the rounds before the last trains on, about, and how often all tasks' weights are averaged.
TASK_DOCS, ROUNDS = 250, 3
#: Words that a worker keeps with their subword ids, of so many bytes at most each, and how many ids, about: some 60 MB, seldom more than half.
CACHE, CACHED_BYTES, CACHED_IDS = 1_000_000, 64, 16_000_000
#: What a document's own pass gives.
DOC = [pa.field("held_out", pa.bool_()), pa.field("n", pa.int64()), pa.field("known", pa.int64()), pa.field("logs", pa.float64()), pa.field("score", pa.float64())]
LN10 = math.log(10)


#: Fixed value: how a byte-level vocabulary of this kind splits a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=1)
def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level vocabulary file (.json) as an encoding by ranks, which spells new words some five times faster than the file's library.

    Ids are ranks where each merge makes the next id; other files are refused.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_symbols())}
    model, special = told["model"], {t["content"]: t["id"] for t in told["added_tokens"]}
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(i >= j for i, j in pairwise(merged)):
        raise ValueError("merges don't make ids in order")
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("words", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=1)
def begins(path: str) -> np.ndarray:
    """Which ids begin with a space."""
    known = tokenizer(path)
    found = np.zeros(known.n_vocab, bool)
    for i, token in enumerate(known.token_byte_values()):
        if token.startswith(b" "):
            found[known.encode_single_token(token)] = True
    return found


class Spellings:
    """Subword ids of the words seen first, and so mostly the common ones, by the words' 64-bit hashes."""

    def __init__(self):
        self.keys, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)  # by hash
        self.ids, self.used = np.zeros(1 << 16, np.uint16), 0

    def put(self, ids: np.ndarray) -> int:
        """Where these ids stand; others take their place but for the first ones, as many as `keep` adds to `used`."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), np.uint16)])
        self.ids[self.used : self.used + len(ids)] = ids
        return self.used

    def keep(self, keys: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.size = (np.insert(old, at, new) for old, new in ((self.keys, keys), (self.begin, begin), (self.size, size)))
        self.used += int(size.sum())


@lru_cache(maxsize=1)
def cache(path: str) -> Spellings:
    """One for a worker."""
    return Spellings()


def tokenized(words: list[bytes], path: str) -> list[bytes]:
    """Packed ids of each word with a space before it.

    The library splits a text at spaces, so all words go in as one text and are told apart by the ids that begin
    with a space. Words that hold other white space could change their neighbours' splits there: then
    each word is a text of its own.
    """
    text = " " + b" ".join(words).decode()
    if len(text.split()) == len(words):
        ids = np.array(tokenizer(path).encode(text, allowed_special="all"), np.uint16)
        at = np.flatnonzero(begins(path)[ids])
        if len(at) == len(words):
            packed, ends = ids.tobytes(), [*(2 * at[1:]).tolist(), 2 * len(ids)]
            return [packed[i:j] for i, j in zip((2 * at).tolist(), ends, strict=True)]
    return [array("H", tokenizer(path).encode(" " + w.decode(), allowed_special="all")).tobytes() for w in words]


def word_ids(found: Words, h: np.ndarray, first: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Subword ids, with a space before each word, of the distinct words with these sorted hashes (first: a place of each) one after the other, and where each word's begin.

    A full cache keeps what it has.
    """
    known = cache(path)
    begin, size = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    at = np.searchsorted(known.keys, h)
    seen = np.flatnonzero(known.keys.take(at, mode="clip") == h) if len(known.keys) else np.zeros(0, np.int64)
    begin[seen], size[seen] = known.begin[at[seen]], known.size[at[seen]]
    new = np.delete(np.arange(len(h)), seen)
    if len(new):
        short = (found.end - found.start)[first[new]] <= CACHED_BYTES
        new, kept = np.concatenate([new[short], new[~short]]), new[short]
        buf, spans = found.buf.tobytes(), (found.start[first[new]].tolist(), found.end[first[new]].tolist())
        fresh = tokenized([buf[i:j] for i, j in zip(*spans, strict=True)], path)
        size[new] = np.fromiter(map(len, fresh), np.int64, len(fresh)) // 2
        begin[new] = known.put(np.frombuffer(b"".join(fresh), np.uint16)) + np.cumsum(size[new]) - size[new]
        if len(known.keys) < CACHE and known.used < CACHED_IDS:
            known.keep(h[kept], begin[kept], size[kept])
    starts = np.concatenate([[0], np.cumsum(size)])
    subs = known.ids.take(np.arange(starts[-1]) + np.repeat(begin - starts[:-1], size))
    if len(known.ids) > 2 * CACHED_IDS:  # a very long text's
        known.ids = known.ids[: known.used].copy()
    return subs, starts


def distinct_words(texts: list, path: str) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words; their distinct hashes, each word's number among these and how often each occurs; the subword ids of the distinct words one after the other, and where each word's begin."""
    found = Words(texts, lower=True)
    h = found.hashes()
    order = np.argsort(h)
    h = h.take(order)
    edge = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=edge[1:])
    at, number = np.flatnonzero(edge), np.empty(len(h), np.int64)
    number[order] = np.cumsum(edge) - 1
    return found, h[at], number, np.diff(at, append=len(h)), *word_ids(found, h[at], order[at], path)


WORD, SUBWORD, PAIR = 0, 1, 2
#: Stands for a text's end among subword ids, of which there are fewer.
END_ID = 0xFFFF
#: Pairs that a task holds before they go out.
HELD_PAIRS = 1 << 19


def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of several (keys, counts), each key once."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def word_counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Counts of words (w: hash; first: the id that begins it), of their subwords (w: id), and of pairs at word starts.

    A pair (w: that before << 16 | that which begins the word or is the end) may come more than once.
    """
    schema = pa.schema([("kind", pa.int8()), ("w", pa.int64()), ("c", pa.int64()), ("first", pa.int32())])
    ids = np.zeros(tokenizer(path).n_vocab, np.int64)
    held: list = []

    def out(kind: int, w: np.ndarray, c: np.ndarray, first: np.ndarray | None = None) -> pa.RecordBatch:
        return batch_of(schema, kind=np.full(len(w), kind, np.int8), w=w, c=c, first=np.zeros(len(w), np.int32) if first is None else first)

    for _, texts in slices(batches):
        found, h, number, times, subs, starts = distinct_words(texts, path)
        yield out(WORD, h.view(np.int64), times, subs[starts[:-1]].astype(np.int32))
        ids += np.bincount(subs, np.repeat(times, np.diff(starts)), len(ids)).astype(np.int64)
        first, last = subs[starts[:-1]].astype(np.int64)[number], subs[starts[1:] - 1].astype(np.int64)[number]  # of each word of the texts
        pairs = np.insert(last, found.first[:-1], END_ID) << 16 | np.insert(first, found.first[1:], END_ID)
        held.append(np.unique(pairs, return_counts=True))
        if sum(len(k) for k, _ in held) > HELD_PAIRS:
            held = [merged(held)]
            if len(held[0][0]) > HELD_PAIRS // 2:
                yield out(PAIR, *held[0])
                held = []
    yield out(PAIR, *merged(held))
    at = np.flatnonzero(ids)
    yield out(SUBWORD, at, ids[at])


COUNTED = "kind byte, w long, c long, first int"


def class_pairs(batches: Iterator[pa.RecordBatch], class_of: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs (w, c) as pairs of classes (k: first * CLASSES + second)."""
    schema = pa.schema([("k", pa.int32()), ("c", pa.int64())])
    whole = np.full(END_ID + 1, A.CLASSES - 1, np.int64)
    whole[: len(class_of)] = class_of
    for batch in batches:
        w = batch.column(0).to_numpy()
        yield batch_of(schema, k=(whole[w >> 16] * A.CLASSES + whole[w & 0xFFFF]).astype(np.int32), c=batch.column(1))


def asked(words: tuple, input_of: np.ndarray, class_of: np.ndarray) -> tuple[list, list]:
    """For `distinct_words` each text's inputs from end to end, and its goals: the class at each word's start and at the end."""
    found, _, number, _, subs, starts = words
    sizes = np.diff(starts)[number]
    at = np.concatenate([[0], np.cumsum(sizes)])  # where each word's ids begin
    spelt = np.arange(at[-1]) + np.repeat(starts[:-1][number] - at[:-1], sizes)
    inputs, goal = input_of[subs][spelt], np.full(at[-1], -1, np.int64)
    goal[at[:-1]] = class_of[subs[starts[:-1]]][number]
    cut = [inputs[i:j] for i, j in pairwise(at[found.first].tolist())], [goal[i:j] for i, j in pairwise(at[found.first].tolist())]
    return [np.concatenate([[A.END], x, [A.END]]).astype(np.int64) for x in cut[0]], [np.append(g, A.CLASSES - 1) for g in cut[1]]


def trained(batches: Iterator[pa.RecordBatch], path: str, input_of: np.ndarray, class_of: np.ndarray, bigram: np.ndarray, start: np.ndarray, steps: int) -> Iterator[pa.RecordBatch]:
    """A task's weights after training on each of its texts, each times the number of windows; nothing without texts."""
    schema = pa.schema([("i", pa.int32()), ("w", pa.float64()), ("n", pa.int64())])
    p, n = A.train_parts((asked(distinct_words(texts, path), input_of, class_of) for _, texts in slices(batches)), bigram, A.unpacked(start), steps)
    if n:
        row = A.packed(p).astype(np.float64) * n
        yield batch_of(schema, i=np.arange(len(row), dtype=np.int32), w=row, n=np.full(len(row), n))


def round_ends(rows: int, first_docs: int) -> list[float]:
    """Up to which share of the training rows each round goes: from `first_docs` of them to all, in even ratios."""
    share = min(1.0, max(first_docs, 1) / max(rows, 1))
    return [share ** ((ROUNDS - 1 - i) / max(1, ROUNDS - 1)) for i in range(ROUNDS)]


def fit(train: DataFrame, path: str, counted: DataFrame, rows: int, first_docs: int) -> tuple[A.Model, np.ndarray]:
    """The model, and by class the log10 of what shares a class out: its tokens, its distinct words and one.

    counted: kind, w, c, first of all training rows; rows: how many these are. Ranks, shares and pairs of
    classes are those of all rows, and every row trains the attention weights: ROUNDS rounds deal the rows out by
    hash, each to one round, and if there are no more than `first_docs`, all to each round. Tasks train on their rows
    of a round and Spark averages their weights by windows. Rounds before the last give a task TASK_DOCS
    rows; the last, with most rows, takes them where they are read. The driver gets counts by id and by pair
    of classes, and one set of weights.
    """
    size = tokenizer(path).n_vocab
    by_id = counted.filter(F.col("kind") == SUBWORD).select("w", "c").toArrow()
    ids = np.zeros(size, np.int64)
    ids[by_id["w"].to_numpy()] = by_id["c"].to_numpy()
    rank = A.ranks_of(ids)
    class_of, input_of = A.classes_of(rank), A.inputs_of(rank)
    begun = counted.filter(F.col("kind") == WORD).groupBy("first").agg((F.sum("c") + F.count(F.lit(1))).alias("mass")).toArrow()
    mass = np.bincount(class_of[begun["first"].to_numpy()], begun["mass"].to_numpy(), A.CLASSES)
    table = map_arrow(counted.filter(F.col("kind") == PAIR).select("w", "c"), lambda b: class_pairs(b, class_of), "k int, c long").groupBy("k").agg(F.sum("c").alias("c")).toArrow()
    pairs = np.full(A.CLASSES**2, 0.1)
    pairs[table["k"].to_numpy()] += table["c"].to_numpy()
    pairs = pairs.reshape(A.CLASSES, A.CLASSES)
    bigram = np.log(pairs / pairs.sum(axis=1, keepdims=True)).astype(np.float32)
    weights, ends, draw = A.packed(A.start_weights()), round_ends(rows, first_docs), 1 << 30
    drawn = F.pmod(F.xxhash64("did", "th"), F.lit(draw))
    for low, high in pairwise([0.0, *ends]):
        low, last = 0.0 if ends[0] == 1 else low, ends[0] < 1 == high
        part = train.filter((drawn >= math.ceil(draw * low)) & (drawn < math.ceil(draw * high)))
        if not last:
            tasks = max(1, math.ceil(rows * (high - low) / TASK_DOCS))
            part = part.repartition(tasks, "did", "th").sortWithinPartitions("did", "th")
        told = map_arrow(part.select("text"), lambda b, now=weights, steps=0 if last else A.STEPS: trained(b, path, input_of, class_of, bigram, now, steps), "i int, w double, n long")
        mean = told.groupBy("i").agg((F.sum("w") / F.sum("n")).alias("w")).toArrow()
        weights = weights.copy()
        weights[mean["i"].to_numpy()] = mean["w"].to_numpy()
    return A.Model(input_of, class_of, bigram, A.unpacked(weights)), np.log10(mass + 1)


def class_logs(model: A.Model, norms: np.ndarray, words: tuple) -> np.ndarray:
    """For each text of `distinct_words` the sum over words of log10 of the class's probability by attention, less its norm; and the end's."""
    sequences, goals = asked(words, model.input_of, model.class_of)
    logs = A.class_scores(model, sequences, goals) / LN10
    scored = np.concatenate(goals)
    scored = scored[scored >= 0]
    logs -= np.where(scored == A.CLASSES - 1, 0.0, norms[scored])
    last = np.cumsum([int((g >= 0).sum()) for g in goals])
    return np.add.reduceat(logs, np.append(0, last[:-1]))


def lm_scores(docs: DataFrame, path: str, folds: int = FOLDS, held_out: int = HELD_OUT, head_words: int = HEAD_WORDS, first_docs: int = FIRST_DOCS) -> DataFrame:
    """A row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id) mod `folds` is not `held_out`. Tokens are the words, A-Z
    lower-cased, and one end; base_score sums log10((c + 1) / (N + V + 1)) over them. Words are counted
    by 64-bit hash. score is the log10 probability of the text's words and end: that of each one's class by
    attention on subword ids, times the word's share of its class, (c + 1) of the class's tokens, distinct words
    and one. Counts of the commonest `head_words` words are broadcast; the rest are joined, which gives the
    same scores. Counts of words, subwords and classes are of all training rows, and attention weights are trained on all of
    them, in rounds of which the first takes about `first_docs`. Each word is one token, as in the base: its first subword's class is predicted
    from all subwords before it, and the word drawn from its class, so every token is scored once, in one window. Very long texts
    only make more windows.
    A null text counts as empty: its end alone. Repeated rows get equal results. Without training rows all
    counts are 0 and attention is untrained. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = keyed(docs).withColumn("held_out", crc_mod("did", folds) == held_out)
    learned = rows.filter(~F.col("held_out")).select("did", "th", "text")
    counted = map_arrow(learned.select("text"), lambda b: word_counts(b, path), COUNTED)
    counted = materialize(counted.groupBy("kind", "w").agg(F.sum("c").alias("c"), F.min("first").alias("first")), "words")
    counts = counted.filter(F.col("kind") == WORD).select("w", "c")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    ends = learned.count()
    total = tokens + ends
    norm = math.log10(total + distinct + (ends > 0) + 1)
    head = counts.orderBy(F.desc("c"), "w").limit(head_words).toArrow()
    w, c = head["w"].to_numpy(), head["c"].to_numpy()
    order = np.argsort(w)
    told = spark.sparkContext.broadcast((w[order], c[order], *fit(learned, path, counted, ends, first_docs)))
    end_score = math.log10(ends + 1) - norm

    def look_up(h: np.ndarray) -> np.ndarray:
        """Head counts of hashes, or 0."""
        keys, values, *_ = told.value
        if not len(keys):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], 0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document (w: a hash of did and th) with what its classes, end and head words give, and one for each word outside the head (doc: null)."""
        schema = pa.schema([("w", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("doc", pa.struct(DOC))])
        for batch, texts in slices(batches, most=1 << 19):
            words = distinct_words(texts, path)
            found, own, number = words[:3]
            own = own.view(np.int64)
            h, n = own[number], look_up(own)[number]
            size, tail = len(texts), n == 0
            did, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            doc = {
                "held_out": batch.column(3), "n": found.count + 1, "known": np.bincount(found.doc[~tail], minlength=size) + int(ends > 0),
                "logs": np.bincount(found.doc, np.log10(n + 1.0), size), "score": class_logs(*told.value[2:], words),
            }
            doc = pa.StructArray.from_arrays([pa.array(doc[f.name], f.type) for f in DOC], fields=DOC)
            own_key = mix(th.astype(np.int64).view(np.uint64) + mix(did.astype(np.int64).view(np.uint64)))  # equal texts are not one key
            yield batch_of(schema, w=own_key.view(np.int64), did=did, th=th, doc=doc)
            at = found.doc[tail]
            yield batch_of(schema, w=h[tail], did=did[at], th=th[at], doc=pa.nulls(len(at), pa.struct(DOC)))

    told_of = "doc struct<held_out: boolean, n: bigint, known: bigint, logs: double, score: double>"
    scored = map_arrow(rows.select("did", "th", "text", "held_out"), score, f"w long, did long, th long, {told_of}")
    joined = scored.join(counts, "w", "left").withColumn("c", F.when(F.col("doc").isNull(), F.coalesce("c", F.lit(0))))
    times = F.count("doc")
    summed = joined.groupBy("did", "th").agg(
        times.cast("int").alias("times"),
        *[F.max(F.col("doc")[f.name]).alias(f.name) for f in DOC],
        (F.count_if(F.col("c") > 0) / times).cast("long").alias("more"),
        (F.coalesce(F.sum(F.log10(F.col("c") + 1)), F.lit(0.0)) / times).alias("more_logs"),
    )
    again = summed.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
    base = F.col("logs") + F.col("more_logs") - (F.col("n") - 1) * norm + end_score
    return again.select(
        F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "held_out", F.col("n").alias("n_tokens"), (F.col("known") + F.col("more")).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.col("logs") + F.col("more_logs")).alias("score"),
    )
