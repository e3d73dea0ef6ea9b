"""Hard negatives by L2AP-style threshold joins of anchors and rows.

Rows and anchors are dealt into blocks, and a task gets a block of each. It puts the rows under an inverted index by
dimension that leaves out the dimensions of a row's tail whose norm can't reach the least threshold alone, adds up partial
scores along posting lists, drops the pairs whose partial score and remaining norms stay below the anchor's threshold,
and finishes the scores of the others. Thresholds rise in a task as its lists fill; between rounds they are lowered for anchors
whose windows are not full yet, until they are or no lower score can count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridwatch.llm.common import materialize

POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between this share of the positive's, in hundredths, and all of it.
LEAST_PERCENT = 80
SCALE = 256
#: Rows and anchors of a block; there are LEAST_BLOCKS blocks of rows at least.
ROWS, ANCHORS, LEAST_BLOCKS = 1 << 16, 1 << 14, 24
#: Rows under one index, and anchors that meet it at once.
INDEXED, AT_ONCE = 2048, 256
#: The part of a window, from its top, that each round covers.
DEPTHS = (0.25, 0.5, 1.0)
HITS = "anchor_id long, top long, vec_id long, score long"
HIT_SCHEMA = pa.schema([("anchor_id", pa.int64()), ("top", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def vectors(column: pa.ChunkedArray) -> np.ndarray:
    """A matrix of whole numbers; short rows end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    if not len(lists):
        return np.zeros((0, 0), np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), int(sizes.max())), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


class Index:
    """Rows under posting lists by dimension. Dimensions stand in falling size; a row's tail of norm below `least` is left out.

    Rows stand by falling length of what is indexed, so a dimension's posting list is the first so many rows.
    """

    def __init__(self, rows: np.ndarray, least: float):
        x = rows.astype(np.float64)
        self.order = np.argsort(-(x**2).sum(axis=0), kind="stable")
        x = x[:, self.order]
        tails = np.sqrt(np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1])
        tails = np.concatenate([tails, np.zeros((len(x), 1))], axis=1)
        length = (tails >= least).sum(axis=1) if least > 0 else np.full(len(x), x.shape[1])
        length = np.minimum(length, x.shape[1])
        self.by = np.argsort(-length, kind="stable")
        self.x, self.length = x[self.by], length[self.by]
        self.rest = tails[self.by, self.length]
        self.held = (self.length[:, None] > np.arange(x.shape[1])[None, :]).sum(axis=0)

    def above(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of the pairs at or above the anchor's threshold."""
        a = anchors.astype(np.float64)[:, self.order]
        tails = np.concatenate([np.sqrt(np.cumsum((a**2)[:, ::-1], axis=1)[:, ::-1]), np.zeros((len(a), 1))], axis=1)
        part = np.zeros((len(self.x), len(a)))
        edges = [0, *(np.flatnonzero(np.diff(self.held)) + 1).tolist(), len(self.held)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):  # dimensions whose lists hold the same rows are added at once
            m = self.held[low] if high > low else 0
            part[:m] += self.x[:m, low:high] @ a[:, low:high].T
        could = part + self.rest[:, None] * tails[:, self.length].T * (1 + 1e-9) >= thresholds[None, :]
        row, at = np.nonzero(could)
        score = part[row, at]
        left = self.length[row] < self.x.shape[1]
        for k in range(0, len(row), 1 << 16):
            own = np.arange(k, min(len(row), k + (1 << 16)))[left[k : k + (1 << 16)]]
            tail = np.arange(self.x.shape[1])[None, :] >= self.length[row[own]][:, None]
            score[own] += (self.x[row[own]] * a[at[own]] * tail).sum(axis=1)
        fine = score >= thresholds[at]
        return at[fine], self.by[row[fine]], np.rint(score[fine]).astype(np.int64)


def exact(rows: np.ndarray, anchors: np.ndarray) -> bool:
    """Whether doubles hold every sum of these products exactly."""
    size = lambda m: float(np.abs(m.astype(np.float64)).max(initial=0.0))
    return max(1, rows.shape[1]) * size(rows) * size(anchors) < 2.0**52


def joined(anchors: np.ndarray, thresholds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) at or above the anchors' thresholds."""
    if not exact(rows, anchors):  # vast components: whole numbers, without an index
        scores = rows @ anchors.T
        row, at = np.nonzero(scores >= thresholds[None, :])
        return at, row, scores[row, at]
    norms = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))
    least = float(np.min(thresholds / np.maximum(norms, 1e-9))) * (1 - 1e-9)
    return Index(rows, least).above(anchors, thresholds)


def firsts(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, limit: int) -> np.ndarray:
    """Places of each group's first `limit` by falling score, then id."""
    order = np.lexsort((ids, -scores, group))
    g = group[order]
    start = np.flatnonzero(np.diff(g, prepend=-1))
    return order[np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g)))) < limit]


def _once(table: pa.Table, key: str) -> pa.Table:
    """One row for each id: that of the least label, then of the least vector."""
    ids = table[key].to_numpy()
    if len(np.unique(ids)) == len(ids):
        return table
    rows = sorted(range(len(ids)), key=lambda i: (ids[i], table["label"][i].as_py(), table["vec"][i].as_py()))
    return table.take([i for k, i in enumerate(rows) if not k or ids[i] != ids[rows[k - 1]]])


def _block_hits(left: pa.Table, right: pa.Table, negatives: bool) -> pa.Table:
    """A block of anchors (with thresholds and windows) against a block of rows: each open window's first hits here."""
    limit = NEGATIVES if negatives else POSITIVES
    rows = _once(right, "vec_id")
    x, row_ids, row_labels = vectors(rows["vec"]), rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    by = np.argsort(row_labels, kind="stable")
    x, row_ids, row_labels = x[by], row_ids[by], row_labels[by]
    a, ids, labels = vectors(left["vec"]), left["anchor_id"].to_numpy(), left["label"].to_numpy()
    width = max(x.shape[1], a.shape[1])
    x, a = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, a))
    sizes = left["tops"].combine_chunks()
    sizes = sizes.chunk(0) if isinstance(sizes, pa.ChunkedArray) else sizes
    per = sizes.value_lengths().to_numpy(zero_copy_only=False)
    owner, tops = np.repeat(np.arange(len(ids)), per), sizes.flatten().to_numpy()
    lows = left["lows"].combine_chunks()
    lows = (lows.chunk(0) if isinstance(lows, pa.ChunkedArray) else lows).flatten().to_numpy()
    told: list[tuple[np.ndarray, ...]] = []

    def part(mine: np.ndarray, theirs: slice) -> None:
        """Some anchors' windows against some rows, a part of the rows at a time; a full window's low end rises."""
        window = np.flatnonzero(np.isin(owner, mine))
        if not len(window) or theirs.stop <= theirs.start:
            return
        low = lows[window].copy()
        held = (np.zeros(0, np.int64),) * 3  # window, id, score
        number = np.full(len(ids), -1)
        number[mine] = np.arange(len(mine))
        own = number[owner[window]]
        first = np.searchsorted(own, np.arange(len(mine) + 1))
        for at in range(theirs.start, theirs.stop, INDEXED):
            r = slice(at, min(theirs.stop, at + INDEXED))
            which, row, score = joined(a[mine], np.minimum.reduceat(low, first[:-1]), x[r])
            fine = (row_labels[r][row] != labels[mine][which]) if negatives else (row_ids[r][row] != ids[mine][which])
            which, row, score = which[fine], row[fine], score[fine]
            count = np.diff(first)[which]
            w = np.repeat(first[which], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            row, score = np.repeat(row_ids[r][row], count), np.repeat(score, count)
            fine = (score <= tops[window][w]) & (score >= low[w])
            held = tuple(np.concatenate([h, n]) for h, n in zip(held, (w[fine], row[fine], score[fine]), strict=True))
            keep = firsts(held[0], held[1], held[2], limit)
            held = tuple(h[keep] for h in held)
            full = np.flatnonzero(np.bincount(held[0], minlength=len(window)) == limit)
            low[full] = np.maximum(low[full], held[2][np.searchsorted(held[0], full, side="right") - 1])
        told.append((ids[owner[window[held[0]]]], tops[window[held[0]]], held[1], held[2]))

    for k in range(0, len(ids), AT_ONCE):
        mine = np.arange(k, min(len(ids), k + AT_ONCE))
        if negatives:
            part(mine, slice(0, len(x)))
        else:  # rows of one label stand together
            for label in np.unique(labels[mine]):
                part(mine[labels[mine] == label], slice(*(int(np.searchsorted(row_labels, label, side=s)) for s in ("left", "right"))))
    columns = [np.concatenate(c) if told else np.zeros(0, np.int64) for c in zip(*told, strict=True)] if told else [np.zeros(0, np.int64)] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], schema=HIT_SCHEMA)


def _hits(asked: DataFrame, rows: DataFrame, blocks: int, negatives: bool) -> DataFrame:
    """(anchor_id, top, vec_id, score): the first rows of each window (tops, lows) of `asked`, over all blocks of rows."""
    parts = max(1, -(-asked.count() // ANCHORS))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.lit(parts)).cast("int")).withColumn("block", numbers(blocks))
    right = rows.withColumn("part", numbers(parts))

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        return _block_hits(a, b, negatives) if a.num_rows and b.num_rows else HIT_SCHEMA.empty_table()

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(meet, HITS)
    first = Window.partitionBy("anchor_id", "top").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= (NEGATIVES if negatives else POSITIVES))


def _filled(asked: DataFrame, rows: DataFrame, blocks: int, negatives: bool) -> list[DataFrame]:
    """Rounds of `_hits`: what is full, or can't become so, is told; windows of the others are asked for again from lower on.

    asked: anchor_id, label, vec, windows (top, low, least) with low to begin at and least to end at.
    """
    limit, told = NEGATIVES if negatives else POSITIVES, []
    for depth in DEPTHS:
        lows = F.transform("windows", lambda w: F.when(F.lit(depth == DEPTHS[-1]), w["least"]).otherwise(F.greatest(w["least"], w["low"] if not negatives and depth == DEPTHS[0] else F.ceil(w["top"] * (1 - depth) + w["least"] * depth) if negatives else F.ceil(w["low"] / 2))))
        windows = asked.withColumns({"tops": F.transform("windows", lambda w: w["top"]), "lows": lows})
        hits = materialize(_hits(windows.drop("windows"), rows, blocks, negatives), "hits")
        ends = windows.select("anchor_id", F.inline(F.arrays_zip("tops", "lows", F.transform("windows", lambda w: w["least"]).alias("least"))))
        full = hits.groupBy("anchor_id", F.col("top").alias("tops")).agg(F.count(F.lit(1)).alias("n"))
        state = materialize(ends.join(full, ["anchor_id", "tops"], "left").withColumn("open", (F.coalesce("n", F.lit(0)) < limit) & (F.col("lows") > F.col("least"))), "windows")
        told.append(hits.join(state.filter("not open").select("anchor_id", F.col("tops").alias("top")), ["anchor_id", "top"], "left_semi"))
        still = state.filter("open").groupBy("anchor_id").agg(F.collect_list("tops").alias("_open"))
        if depth == DEPTHS[-1] or not still.limit(1).count():
            break
        asked = asked.join(still, "anchor_id").withColumn("windows", F.filter("windows", lambda w: F.array_contains("_open", w["top"]))).drop("_open")
    return told


def hard_negatives(embeddings: DataFrame, anchor_every: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: each anchor's and positive's first NEGATIVES negatives.

    Rows need a label, a vector without null or non-finite components, and a vec_id; ids divisible by 7 take the next label.
    Scores are inner products of floor(256 * component). Positives are the first POSITIVES other rows of the anchor's label, by falling
    score, then id; negatives are rows of other labels within 80 to 100 percent of the positive's score, in the same order.
    Positives of negative score have no such rows. An id with several rows counts once, as its row of the least label, then vector. Vectors
    of unlike length are filled up with zeros; an empty one scores 0. Labels are integers, and anchors those with vec_id divisible by `anchor_every`.
    A group's equal vectors all count, but a block tells only its first rows of a window. Other columns are not read; an empty
    table gives an empty result. Sums beyond 64 bits wrap around.
    """
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = embeddings.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("long")).alias("vec"))
    size = known.count()
    blocks = max(LEAST_BLOCKS, -(-size // ROWS))
    rows = known.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    least = F.min(F.struct("label", "vec")).alias("m")
    anchors = known.filter(F.col("vec_id") % anchor_every == 0).groupBy(F.col("vec_id").alias("anchor_id")).agg(least).select("anchor_id", "m.*")
    # Where a label's scores are normal with the mean square of all rows, about 20 or more lie above this; it only decides where the first round begins.
    squares = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v)
    spread = known.agg(F.coalesce(F.sqrt(F.avg(squares) / F.greatest(F.avg(F.size("vec")), F.lit(1))), F.lit(0.0)).alias("spread"))
    deep = F.greatest(F.lit(0.0), F.sqrt(2 * F.log(F.greatest(F.col("n") / 40, F.lit(1.0)))) - 0.5)
    held = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    begun = anchors.join(held, "label").crossJoin(F.broadcast(spread)).withColumn("low", F.floor(deep * F.col("spread") * F.sqrt(squares)).cast("long"))
    most = F.lit((1 << 63) - 1)
    one = F.array(F.struct(most.alias("top"), F.col("low"), F.lit(0).cast("long").alias("least")))
    asked = materialize(begun.select("anchor_id", "label", "vec", one.alias("windows")), "anchors")
    union = lambda parts: parts[0] if len(parts) == 1 else parts[0].unionByName(union(parts[1:]))
    positives = materialize(union(_filled(asked, rows, blocks, False)).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("_p")), "positives")
    floor = F.ceil(F.col("top") * F.lit(LEAST_PERCENT) / 100).cast("long")
    tops = positives.select("anchor_id", F.col("positive_score").alias("top")).distinct().select("anchor_id", F.struct("top", floor.alias("low"), floor.alias("least")).alias("w"))
    wanted = materialize(asked.drop("windows").join(tops.groupBy("anchor_id").agg(F.collect_list("w").alias("windows")), "anchor_id"), "asked")
    found = union(_filled(wanted, rows, blocks, True)).select("anchor_id", F.col("top").alias("positive_score"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.drop("_p").join(found, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
