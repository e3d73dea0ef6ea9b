"""Toxicity: every significant segment of token log-odds, summed up by extreme-value calibration.

A token's chance of standing in a toxic document is a beta (two-class Dirichlet) posterior whose prior is the posterior
of the token's head (its first 6 bytes, before that 5, then 4, then all tokens): a word that was never seen takes its
head's chance. Its log-odds against all tokens, less DRIFT, make ordinary text fall, so a segment that rises stands
out; Ruzzo and Tompa's scan finds all such segments of a text in linear time. The greatest segment of a clean text
of n tokens follows a Gumbel law whose place grows with ln n; a document's segments above that place are summed in the law's units.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import NOT_TERM, Words, crc_mod, id_and_text, map_arrow, materialize, slices

#: The heads of a word, in bytes; the word itself is the last unit.
HEADS = (4, 5, 6)
LEVELS, BUCKETS, CHUNK = len(HEADS) + 1, 1 << 18, 1 << 13
#: Tokens that the prior counts as, and the log-odds that each token loses.
PRIOR, DRIFT = 10.0, 2.0
#: Labelled documents that are learnt from: all, or of more a share by the hash of the id that has about so many.
LABELLED = 1 << 18
#: A passage is told if chance makes as good a one in fewer than one of 20 clean texts of this length.
SIGNIFICANCE = 0.05
FOLDS, HELD_OUT = 5, 0
PARTS = LEVELS * BUCKETS // CHUNK
PASSAGES = "array<struct<start:int,n_words:int,score:double>>"
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_tokens", pa.int64()), ("passages", pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("score", pa.float64())])))]
)
DDL = f"doc_id long, held_out boolean, score double, predicted int, n_tokens long, passages {PASSAGES}"


class Units:
    """The tokens of some texts, each with a bucket by level; a level counts where the word is longer than its head."""

    def __init__(self, texts: list):
        self.words = w = Words(texts, lower=True, space=NOT_TERM)
        bucket = lambda h: (h >> np.uint64(20) & np.uint64(BUCKETS - 1)).astype(np.int64)
        heads = bucket(w.hashes(*HEADS))
        size = w.end - w.start
        self.levels = [(k * BUCKETS + heads[k], size > n) for k, n in enumerate(HEADS)] + [((LEVELS - 1) * BUCKETS + bucket(w.hashes()), np.ones(len(size), bool))]


def unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's counts of units by class, in parts of CHUNK buckets; the last part is the tokens by class."""
    counts, tokens = np.zeros((2, LEVELS * BUCKETS), np.int64), np.zeros(2, np.int64)
    for batch, texts in slices(batches):
        toxic = np.array(batch.column(batch.schema.get_field_index("toxic")))
        u = Units(texts)
        of = toxic[u.words.doc]
        for c in (0, 1):
            tokens[c] += (of == c).sum()
            for at, on in u.levels:
                np.add.at(counts[c], at[on & (of == c)], 1)
    found = [k for k in range(PARTS) if counts[:, k * CHUNK : (k + 1) * CHUNK].any()]
    told = [counts[:, k * CHUNK : (k + 1) * CHUNK].tobytes() for k in found] + [tokens.tobytes()]
    yield pa.RecordBatch.from_arrays([pa.array([*found, PARTS], pa.int32()), pa.array(told, pa.binary())], names=["part", "counts"])


def added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table["counts"].to_pylist())
    return pa.table({"part": table["part"].slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


@dataclass
class LogOdds:
    counts: np.ndarray
    tokens: np.ndarray

    def of(self, u: Units, toxic: np.ndarray | None = None) -> np.ndarray:
        """Each token's log-odds less DRIFT; with `toxic`, as if the text itself had not been counted."""
        doc, mask = u.words.doc, 0 if toxic is None else toxic[u.words.doc]
        n = self.tokens - (0 if toxic is None else np.array([np.where(toxic == c, u.words.count, 0) for c in (0, 1)]).T[doc])
        base = (n[..., 1] + 0.5) / (n.sum(axis=-1) + 1.0)
        f = np.broadcast_to(base, len(doc)).copy()
        for at, on in u.levels:
            if not on.any():
                continue
            at, seen = at[on], self.counts[:, at[on]].astype(float)
            if toxic is not None:
                _, back, own = np.unique(doc[on] * (LEVELS * BUCKETS) + at, return_inverse=True, return_counts=True)
                seen -= np.array([np.where(mask[on] == c, own[back], 0) for c in (0, 1)])
            f[on] = (seen[1] + PRIOR * f[on]) / (seen.sum(axis=0) + PRIOR)
        return np.log(f / (1 - f)) - np.log(base / (1 - base)) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, sum) of all maximal scoring segments, by Ruzzo and Tompa's linear scan over runs of one sign."""
    up = scores > 0
    if not up.any():
        return []
    edge = np.flatnonzero(np.diff(up.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    held: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, the nearest held one that starts lower
    for start, end, low, high in zip(edge[::2].tolist(), edge[1::2].tolist(), sums[edge[::2]].tolist(), sums[edge[1::2]].tolist(), strict=True):
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= low:
                j = held[j][4]
            if j < 0 or held[j][3] >= high:
                held.append((start, end, low, high, j))
                break
            start, low = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, high - low) for a, b, low, high, _ in held]


def found_segments(model: LogOdds, texts: list, toxic: np.ndarray | None = None) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """The token count and the segments of each text."""
    u = Units(texts)
    s, first = model.of(u, toxic), u.words.first
    any_up = np.add.reduceat(np.append(s > 0, False), np.minimum(first[:-1], len(s))) * (u.words.count > 0) if len(texts) else ()
    return u.words.count, [segments(s[a:b]) if up else [] for a, b, up in zip(first[:-1], first[1:], any_up, strict=True)]


@dataclass
class Calibration:
    """Gumbel's place at one token, its growth with ln n and its width, and the logistic curve on the sum of segments above it."""

    place: float
    growth: float
    width: float
    slope: float
    offset: float

    def excess(self, segment: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        return (segment - self.place - self.growth * np.log(np.maximum(tokens, 1))) / self.width

    def total(self, found: list[float], tokens: int) -> float:
        """The excesses of the segments above chance, or without any the best one's (below zero)."""
        over = self.excess(np.array([0.0, *found]), np.array(tokens))
        return float(over[over > 0].sum()) if (over > 0).any() else float(over.max())

    def score(self, totals: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.arcsinh(totals) + self.offset, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (0 at least) and offset by Newton's steps, with a weak prior that keeps separable data finite."""
    design, w, prior = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2), np.array([0.05, 0.01])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -500, 500)))
        slope = design.T @ (y - p) - prior * w
        bend = (design * (p * (1 - p))[:, None]).T @ design + np.diag(prior)
        step = np.linalg.solve(bend, slope)
        w = w + step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
    return (float(w[0]), float(w[1])) if w[0] >= 0 else (0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))))


def fit(labelled: DataFrame) -> tuple[LogOdds, Calibration] | None:
    """The model of labelled (doc_id, text, toxic) rows: counts, then the calibration of segments found as if each row had not been counted.

    Counts come to the driver as LEVELS * BUCKETS numbers by class, and two numbers for each labelled row.
    """
    table = map_arrow(labelled, unit_counts, "part int, counts binary").groupBy("part").applyInArrow(added, "part int, counts binary").toArrow()
    counts, tokens = np.zeros((2, LEVELS * BUCKETS), np.int64), np.zeros(2, np.int64)
    for k, told in zip(table["part"].to_pylist(), table["counts"].to_pylist(), strict=True):
        if k == PARTS:
            tokens += np.frombuffer(told, np.int64)
        else:
            counts[:, k * CHUNK : (k + 1) * CHUNK] = np.frombuffer(told, np.int64).reshape(2, CHUNK)
    model = LogOdds(counts, tokens)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            toxic = np.array(batch.column(batch.schema.get_field_index("toxic")))
            n, found = found_segments(shared.value, texts, toxic)
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(n, pa.int64()), pa.array([[s for *_, s in x] for x in found], pa.list_(pa.float64()))], names=["toxic", "n", "found"])

    known = materialize(map_arrow(labelled, tell, "toxic int, n long, found array<double>"), "segments")
    best, size = F.coalesce(F.array_max("found"), F.lit(0.0)), F.log(F.greatest(F.col("n"), F.lit(1)).cast("double"))
    clean = known.filter("toxic = 0").agg(F.avg(best).alias("s"), F.avg(size).alias("l"), F.var_pop(best).alias("vs"), F.var_pop(size).alias("vl"), F.covar_pop(best, size).alias("c")).first()
    if clean.s is None:
        return None
    growth = max(0.0, clean.c / clean.vl) if clean.vl else 0.0
    width = max(0.1, np.sqrt(6 * max(0.0, clean.vs - 2 * growth * clean.c + growth**2 * clean.vl)) / np.pi)
    shape = Calibration(clean.s - growth * clean.l - np.euler_gamma * width, growth, width, 0.0, 0.0)
    over = lambda x: (x - shape.place - shape.growth * size) / shape.width
    above = F.aggregate(F.filter("found", lambda x: over(x) > 0), F.greatest(over(F.lit(0.0)), F.lit(0.0)), lambda s, x: s + over(x))
    rows = known.select(F.when(over(best) > 0, above).otherwise(over(best)).alias("x"), "toxic").toArrow()
    x, y = rows["x"].to_numpy(), rows["toxic"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    shape.slope, shape.offset = logistic(np.arcsinh(x), y)
    return model, shape


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """A row for each document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on), n_tokens, passages.

    Learns from documents whose crc32(doc_id) mod `folds` is not `held_out` and that `labels` (doc_id, toxic) marks 0 or 1:
    all of them, or of more than LABELLED a share by the hash of the id. Several labels of one id count as one, the
    greatest; a null id or label is none. Scores come from the whole text alone. `passages` are the significant segments: first word, words
    and sum of log-odds, in order. Null and empty texts count as no token; their score is low, as a clean text's. Repeated rows each get
    a row. Without labels of both classes every score is 0. Very long texts only take time in proportion. Other columns of both tables are not read; an
    empty table gives an empty result.
    """
    base = id_and_text(docs).withColumn("held_out", crc_mod("doc_id", folds) == held_out)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    train = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter(crc_mod("doc_id", folds) != held_out)
    share = min(1.0, LABELLED / max(1, train.count()))
    if share < 1:
        train = train.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    labelled = base.filter("text is not null and not held_out").join(F.broadcast(train), "doc_id").select("doc_id", "text", "toxic")
    told = docs.sparkSession.sparkContext.broadcast(fit(labelled))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            if told.value is None:
                n, found, scores = Units(texts).words.count, [[] for _ in texts], np.zeros(len(texts))
            else:
                model, shape = told.value
                n, found = found_segments(model, texts)
                scores = shape.score(np.array([shape.total([s for *_, s in x], k) for x, k in zip(found, n, strict=True)]))
                found = [[{"start": a, "n_words": b - a, "score": s} for a, b, s in x if shape.excess(np.array(s), np.array(k)) > -np.log(SIGNIFICANCE)] for x, k in zip(found, n, strict=True)]
            columns = [batch.column(batch.schema.get_field_index("doc_id")), batch.column(batch.schema.get_field_index("held_out")), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32)), pa.array(n, pa.int64()), pa.array(found, SCHEMA.field("passages").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)

    return map_arrow(base, score, DDL)
