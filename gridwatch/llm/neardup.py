"""MinHash near-dedup by an inverted join of signature coordinates.

Each class of equal shingle sets is posted under its (coordinate, value) tokens. A pair with `MATCHES`
equal coordinates of `COORDINATES` shares a token among each one's COORDINATES - MATCHES + 1 rarest, so
only these are posted (the prefix), and tokens that one class alone has need no posting at all. In each
posting all classes are first held against one pivot, the one nearest the group's middle; later only pairs
that are still in different components and whose common shingles, counted by cell of the hash space, could
suffice are counted (the skip). Counts at or above `MATCHES` go on to the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import Words, batch_of, gram_hashes, inside, map_arrow, materialize, mix, slices
from gridwatch.llm.lines import NO_ID, keyed
from gridwatch.operators.components import components

SHINGLE, PERCENT = 5, 75
#: At a similarity of exactly 0.75 a pair has fewer matches with a probability of about 1e-5.
COORDINATES, MATCHES = 48, 24
#: Parts of the hash space by which the shingles that pairs may share are counted.
CELLS = 128
_draw = np.random.default_rng(11)
_FLIP = _draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_ODD = _draw.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SIGNED = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("cid", pa.int64()), ("cid2", pa.int64()), ("sig", pa.list_(pa.int64()))])
SIGNED_DDL = "did long, th long, n long, cid long, cid2 long, sig array<long>"


def shingle_sets(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets of shingle hashes, one after the other and each in order, and their sizes."""
    w = Words(texts, lower=True)
    h = w.hashes()
    at = inside(w, SHINGLE)
    grams, owner = gram_hashes(h, SHINGLE)[at], w.doc[at]
    for d in np.flatnonzero((w.count > 0) & (w.count < SHINGLE)):  # too short: the whole sequence
        n = w.count[d]
        grams = np.append(grams, gram_hashes(h[w.first[d] : w.first[d] + n], n) ^ np.uint64(n))
        owner = np.append(owner, d)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))[: len(grams)]
    return grams[new], np.bincount(owner[new], minlength=len(texts))


def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and signature of each document's set; empty sets have no signature."""
    for batch, texts in slices(batches, most=1 << 19):
        grams, size = shingle_sets(texts)
        end = np.cumsum(size)
        full = np.flatnonzero(size)
        start = (end - size)[full]
        sig = np.zeros((len(full), COORDINATES), np.uint64)
        for i in range(COORDINATES if len(full) else 0):
            sig[:, i] = mix(np.minimum.reduceat((grams ^ _FLIP[i]) * _ODD[i], start) + np.uint64(i))
        digest = np.zeros((len(texts), 2), np.int64)
        for d in full:
            digest[d] = np.frombuffer(xxhash.xxh3_128_digest(grams[end[d] - size[d] : end[d]].tobytes()), "<i8")
        width = np.zeros(len(texts), np.int32)
        width[full] = COORDINATES
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(width)), pa.int32()), pa.array(sig.view(np.int64).ravel()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists], schema=SIGNED)


def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid, text, sig -> cid, sig, and the set and its size."""
    schema = pa.schema([("cid", pa.int64()), ("sig", pa.list_(pa.int64())), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])
    for batch, texts in slices(batches, most=1 << 19):
        grams, size = shingle_sets(texts)
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(grams.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size), lists], schema=schema)


def matches(a: str, b: str):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("cid").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def counted(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with enough equal coordinates."""
    both = pairs.join(side(sets, "a", "sig"), "a").join(side(sets, "b", "sig"), "b")
    return both.withColumn("equal", matches("sig_a", "sig_b")).filter(F.col("equal") >= MATCHES).drop("sig_a", "sig_b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    both = pairs.join(side(sets, "a", "n", "shingles"), "a").join(side(sets, "b", "n", "shingles"), "b")
    both = both.withColumn("shared", F.size(F.array_intersect("shingles_a", "shingles_b")))
    return both.filter(100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cid, toks, n, shingles, lone -> cid, toks, n, v, cells: how many shingles beside the lone ones, in all and by cell."""
    schema = pa.schema([("cid", pa.int64()), ("toks", pa.list_(pa.int64())), ("n", pa.int64()), ("v", pa.int64()), ("cells", pa.list_(pa.int32()))])
    for batch in batches:
        rows = batch.num_rows
        count = np.zeros(rows * CELLS, np.int64)
        for column, sign in ((3, 1), (4, -1)):
            lists = batch.column(column)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            count += sign * np.bincount(np.repeat(np.arange(rows), size) * CELLS + (lists.flatten().to_numpy() & (CELLS - 1)), minlength=len(count))
        cells = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * CELLS), pa.array(count.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(count.reshape(-1, CELLS).sum(1)), cells], schema=schema)


def common_parts(chosen: DataFrame, sets: DataFrame) -> DataFrame:
    """cid, toks, n, v and cells of each chosen class: v of its n shingles are in another chosen class too.

    Two classes share at most the lesser v, and at most the sum of the lesser counts by cell of the hash
    space, so these rule out most pairs of a group whose members each have changes of their own: changes
    at different places fall into different cells. One shuffle of the chosen sets' shingles.
    """
    held = sets.join(chosen, "cid").select("cid", "toks", "n", "shingles")
    alone = held.select("cid", F.explode("shingles").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("df"), F.min("cid").alias("cid")).filter("df = 1")
    alone = alone.groupBy("cid").agg(F.collect_list("g").alias("lone"))
    return map_arrow(held.join(alone, "cid", "left").select("cid", "toks", "n", "shingles", "lone"), celled, "cid long, toks array<long>, n long, v long, cells array<int>")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """A row for each document: doc_id, n_shingles, component_id, kept, th (hash of the text), component.

    Documents link when 100 * shared >= percent * united over their sets of lower-cased five-word
    shingles (fewer words: the whole sequence is the one shingle), with `percent` 75 or more;
    component_id is the least doc_id reachable and kept tells whether it is the document's own. A null or
    wordless text has an empty set and links with nothing. A null doc_id counts as the least id. Repeated
    rows share a component, and all rows with its least id are kept. `component` is one number for each component
    (null without words): one id with different texts can be the least of several. Other columns are not read; an empty table
    gives an empty result. Very long texts take time in proportion, and their set of shingle hashes is one row.
    """
    rows = keyed(docs)
    table = materialize(map_arrow(rows, signed, SIGNED_DDL), "signatures")
    members = table.drop("sig")
    classes = table.filter("n > 0").groupBy("cid", "cid2").agg(F.min(F.struct("did", "th")).alias("r"), F.first("sig").alias("sig"))
    classes = materialize(classes.select("cid", "r.did", "r.th", "sig"), "classes")

    tokens = classes.select("cid", F.explode("sig").alias("tok"))
    shared = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    ranked = tokens.join(shared, "tok").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("t")).filter(F.size("t") >= MATCHES)
    ranked = ranked.withColumn("weight", F.aggregate("t", F.lit(0).cast("long"), lambda s, x: s + x["df"]))
    posted = ranked.select("cid", "weight", F.explode(F.slice("t", F.lit(1), F.size("t") - (MATCHES - 1))).alias("t")).select("cid", "weight", "t.tok")
    posted = materialize(posted, "postings")

    chosen = posted.select("cid").distinct().join(classes, "cid")
    texts = chosen.join(rows.withColumnRenamed("text", "full_text"), ["did", "th"]).dropDuplicates(["did", "th"])
    sets = map_arrow(texts.select("cid", F.col("full_text").alias("text"), "sig"), with_sets, "cid long, sig array<long>, n long, shingles array<long>")
    sets = materialize(sets, "sets")

    # Each class against the pivot (with the most widely shared coordinates) of its postings that it shares most with.
    pivots = posted.groupBy("tok").agg(F.max_by("cid", F.struct("weight", "cid")).alias("b"), F.count(F.lit(1)).alias("df")).filter("df > 1")
    stars = posted.join(pivots.select("tok", "b"), "tok").filter("cid <> b").select(F.col("cid").alias("a"), "b").distinct()
    best = counted(stars, sets).groupBy("a").agg(F.max_by("b", F.struct("equal", "b")).alias("b"))
    links = materialize(confirmed(best, sets, percent), "links")
    comp = components(links)

    # Pairs of a posting that are not yet in one component; members of its largest one need no count among themselves.
    at = posted.select("cid", "tok").join(comp.select(F.col("node").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    at = materialize(at, "placed")
    mixed = at.join(at.groupBy("tok").agg(F.countDistinct("comp").alias("comps")).filter("comps > 1").select("tok"), "tok")
    held_at = mixed.groupBy("cid").agg(F.collect_list("tok").alias("toks"))  # at most COORDINATES - MATCHES + 1
    mixed = materialize(mixed.join(common_parts(held_at, sets), "cid").filter(100 * F.col("v") >= percent * F.col("n")), "mixed")
    most = mixed.groupBy("tok", "comp").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n")).groupBy("tok")
    most = most.agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.min("n").alias("low")).filter("comps > 1")
    room = ((100 + percent) * F.col("v") - percent * F.col("n")) / percent  # the largest partner's size
    mixed = mixed.join(most.select("tok", "main", "low"), "tok").filter(room >= F.col("low"))
    minor = mixed.filter("comp <> main").select("tok", F.col("cid").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("v").alias("vx"), F.col("cells").alias("px"), F.col("toks").alias("tx"))
    other = mixed.select("tok", F.col("cid").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("ny"), F.col("v").alias("vy"), F.col("cells").alias("py"), F.col("toks").alias("ty"), "main")
    least = percent * (F.col("nx") + F.col("ny"))
    by_cell = F.aggregate(F.zip_with("px", "py", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda s, x: s + x)
    once = F.array_min(F.array_intersect("tx", "ty")) == F.col("tok")  # a pair counts at the first posting it shares
    may_link = ((100 + percent) * F.least("vx", "vy") >= least) & once & ((100 + percent) * by_cell >= least)
    pairs = minor.join(other, "tok").filter(F.expr("cx <> cy and (cy = main or x < y)") & may_link)
    pairs = pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    more = materialize(confirmed(counted(pairs, sets), sets, percent), "links")
    if not more.isEmpty():
        comp = components(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more))

    held = members.join(comp.select(F.col("node").alias("cid"), "comp"), "cid", "left").withColumn("comp", F.when(F.col("n") > 0, F.coalesce("comp", "cid")))
    low = held.filter("n > 0").groupBy("comp").agg(F.min("did").alias("least"))
    out = held.join(low, "comp", "left").withColumn("least", F.coalesce("least", "did"))
    return out.select(F.nullif("did", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif("least", F.lit(NO_ID)).alias("component_id"), (F.col("did") == F.col("least")).alias("kept"), "th", F.col("comp").alias("component"))
