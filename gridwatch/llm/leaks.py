"""Benchmark decontamination by SimHash windows, multi-index Hamming blocks and exact weighted similarity.

DataFrame functions only. Windows as long as an item are made where a document holds enough shingles that
items of that length have. A window finds its items through the blocks of its fingerprint: of two prints within
RADIUS bits, one of BLOCKS blocks differs in RADIUS // BLOCKS bits at most, so every item is posted under all
values that near in each block, and no print within the radius is missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import SPACE_CLASS, materialize
from gridwatch.llm.lines import NO_ID, keyed

SHINGLE, SIMILARITY = 5, 0.75
#: Bits of a fingerprint, its blocks, and how far apart two may be. At a similarity of 0.75 a bit differs with a
#: probability of 0.172 at most, so 22 of 128 do; the radius is 5.8 standard deviations more.
BITS, BLOCKS, RADIUS = 128, 16, 47
BLOCK = BITS // BLOCKS
#: What a block may differ by.
MASKS = [m for m in range(1 << BLOCK) if m.bit_count() <= RADIUS // BLOCKS]
#: Rows of a benchmark's tables (shingles and postings, about 60 bytes each) that are broadcast; larger ones are joined by shuffles.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE_CLASS + "+"), lambda x: x != "")


def shingles(df: DataFrame, keep: list[str]) -> DataFrame:
    """keep, h: the hash of the five words at each position; none for fewer words."""
    split = df.select(*keep, words(F.col("text")).alias("w"))
    h = F.transform("w", lambda x, i: F.xxhash64(x, *[F.get(F.col("w"), i + k) for k in range(1, SHINGLE)]))
    return split.select(*keep, F.slice(h, F.lit(1), F.greatest(F.lit(0), F.size("w") - (SHINGLE - 1))).alias("h"))


def windows_near(hits: Column, size: Column, need: Column, total: Column) -> Column:
    """Starts of all windows of `size` shingle positions that hold `need` of the sorted hit positions, each once."""
    most = lambda j: F.least(F.get(hits, j), total - size)
    least = lambda j: F.greatest(F.lit(0), F.get(hits, j + need - 1) - size + 1, F.coalesce(F.when(j > 0, most(j - 1) + 1), F.lit(0)))
    runs = F.transform(F.sequence(F.lit(0), F.size(hits) - need), lambda j: F.when(least(j) <= most(j), F.sequence(least(j), most(j))).otherwise(F.array().cast("array<int>")))
    return F.when(F.size(hits) >= need, F.flatten(runs)).otherwise(F.array().cast("array<int>"))


def features(h: Column) -> Column:
    """The members of a sorted array as a set: an equal one's n-th occurrence counts as its own member."""
    nth = lambda x, i: i - F.array_position(h, x).cast("int") + 2
    return F.transform(h, lambda x, i: F.when((i > 0) & (F.get(h, i - 1) == x), F.xxhash64(x, nth(x, i))).otherwise(x))


def fingerprints(sets: DataFrame, keys: list[str], members: str) -> DataFrame:
    """keys, f0, f1: the 128-bit SimHash of each row's set. A bit is set if more than half of the members have it.

    Two counters of 32 bits share a long, so a set may be as large as an array can be.
    """
    # Outer, as else a filter on the set's size is pushed below what makes the set, and makes it anew for each member.
    each = sets.select(*keys, F.explode_outer(members).alias("m0")).filter("m0 is not null").withColumn("m1", F.xxhash64(F.col("m0"), F.lit(1)))
    lanes = [F.expr(f"sum(shiftright({m}, {k}) & {(1 << 32) + 1}L) AS {m}_{k}") for m in ("m0", "m1") for k in range(32)]
    summed = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"), *lanes)
    half = lambda m, k: f"{m}_{k} & {(1 << 32) - 1}L" if k < 32 else f"shiftrightunsigned({m}_{k - 32}, 32)"
    print_of = lambda m: F.expr(" | ".join(f"if(2 * ({half(m, k)}) > members, shiftleft(1L, {k}), 0L)" for k in range(64)))
    return summed.select(*keys, print_of("m0").alias("f0"), print_of("m1").alias("f1"))


def blocks(f0: Column, f1: Column) -> Column:
    """The (block, part) pairs of a fingerprint."""
    half = BLOCKS // 2
    part = lambda b: F.shiftrightunsigned(f0 if b < half else f1, b % half * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1)).cast("int")
    return F.array(*[F.struct(F.lit(b).alias("block"), part(b).alias("part")) for b in range(BLOCKS)])


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `windows` (n, f0, f1, ...) with each `item` of `items` (item, n, f0, f1) of the same n whose print is within RADIUS bits, once each."""
    posted = items.select("item", "n", F.col("f0").alias("i0"), F.col("f1").alias("i1"), F.explode(blocks(F.col("f0"), F.col("f1"))).alias("b"))
    masks = F.array(*[F.lit(m) for m in MASKS])
    posted = posted.select("item", "n", "i0", "i1", F.col("b.block").alias("block"), F.explode(F.transform(masks, lambda m: F.col("b.part").bitwiseXOR(m))).alias("part"))
    if items.count() * BLOCKS * len(MASKS) <= BROADCAST_ROWS:
        posted = F.broadcast(posted)
    keys = [c for c in windows.columns if c not in ("f0", "f1")]
    asked = windows.withColumn("b", F.explode(blocks(F.col("f0"), F.col("f1")))).select(*keys, "f0", "f1", "b.block", "b.part")
    met = asked.join(posted, ["n", "block", "part"])
    apart = F.bit_count(F.col("f0").bitwiseXOR(F.col("i0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("i1")))
    return met.filter(apart <= RADIUS).select(*keys, "item").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity, th: benchmark items that documents (th: hash of the text) hold, the best window of each.

    A window has as many words as the item (or is the whole document if that is shorter), lower-cased, at
    any position. Windows find items by SimHash within RADIUS bits; then the exact weighted similarity of
    five-word shingles decides: 0.75 or more (`similarity`, not less). An equal shingle's n-th occurrence counts
    as a shingle of its own in both. At exactly 0.75 a window is outside the radius with a probability below
    1e-8. Windows are made only where the document has enough shingles of items of that length to reach the
    similarity, which loses none. Work for a document that holds an item grows with the square of the
    item's length. Items and documents of fewer than five words, null or empty, match nothing. A null
    doc_id or item_id stays null in the result; repeated documents give one row for an item (of different
    texts with one doc_id each gives its own), repeated items one each; of equal windows the first is told. Empty tables give an empty result.
    """
    rows = keyed(docs)
    named = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).withColumn("item", F.xxhash64("text"))
    items = materialize(shingles(named.filter("text is not null").dropDuplicates(["item"]), ["item"]).withColumn("n", F.size("h")), "items").filter("n > 0")
    posted = items.select("n", F.explode("h").alias("g")).distinct()
    held = items.select("item", "n", F.sort_array("h").alias("h")).select("item", "n", features(F.col("h")).alias("item_set"))
    prints = materialize(fingerprints(held, ["item", "n"], "item_set"), "prints")
    if (items.agg(F.sum("n")).first()[0] or 0) <= BROADCAST_ROWS:
        posted, held = F.broadcast(posted), F.broadcast(held)

    # Nothing but the keys stands beside the generator: an array there would be copied, or made anew, for each row.
    # Outer, as else a filter on the array's size is pushed below the words and splits the text for each of them.
    at = shingles(rows, ["did", "th"]).select("did", "th", F.posexplode_outer("h").alias("pos", "g"))
    hits = at.join(posted, "g").groupBy("did", "th", "n").agg(F.sort_array(F.collect_set("pos")).alias("hits"))
    # Of i shared shingles i / (n + size - i) is the similarity at most, so i is similarity * n at least.
    hits = materialize(hits.filter(F.size("hits") >= F.ceil(F.lit(similarity) * F.col("n") - 1e-9)), "hits")

    again = materialize(shingles(rows.join(hits.select("did", "th").distinct(), ["did", "th"], "left_semi").dropDuplicates(["did", "th"]), ["did", "th"]), "shingles")
    size = F.least(F.col("n"), F.size("h"))
    need = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + size) - 1e-9).cast("int")
    starts = windows_near(F.col("hits"), size, need, F.size("h"))
    window = F.sort_array(F.slice("h", F.col("start") + 1, F.col("size")))
    # Only starts are generated and only numbers leave the stage: all windows of a long item at once would fill the memory.
    cut = again.join(hits, ["did", "th"]).select("did", "th", "n", "h", size.alias("size"), F.explode(starts).alias("start"))
    windows = materialize(fingerprints(cut.withColumn("win", window).withColumn("window", features(F.col("win"))), ["did", "th", "n", "size", "start"], "window"), "windows")
    met = within_radius(windows, prints)

    sets = again.join(met, ["did", "th"]).withColumn("win", window).withColumn("window", features(F.col("win"))).join(held.drop("n"), "item")
    shared = sets.select("did", "th", "item", "start", "size", (F.col("size") + F.size("item_set")).alias("both"), F.size(F.array_intersect("window", "item_set")).alias("shared"))
    exact = shared.withColumn("similarity", F.col("shared") / (F.col("both") - F.col("shared")))
    best = exact.groupBy("did", "th", "item").agg(F.max_by(F.struct("start", "size", "similarity"), F.struct("similarity", -F.col("start"))).alias("b")).filter(F.col("b.similarity") >= similarity)  # not before: the filter would be pushed below and sort a window for each shingle
    return best.join(named.select("item", "item_id"), "item").select(
        F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "item_id", F.col("b.start").alias("start"), (F.col("b.size") + SHINGLE - 1).alias("n_words"), F.col("b.similarity").alias("similarity"), "th"
    )
