"""Line dedup: hashes dealt out by ranges, streamed in order of document and position, and keep bitmaps."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import SPACE_BYTES, batch_of, id_and_text, map_arrow, slices

#: Stands for a null doc_id in keys.
NO_ID = -(1 << 63)
KEYS = ["h1", "h2", "did", "th", "pos"]
POSTING = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("did", pa.int64()), ("th", pa.int64()), ("pos", pa.int32())])
STREAMED = pa.schema([("kind", pa.int8()), *POSTING, ("n", pa.int64()), ("head", pa.bool_()), ("part", pa.int32())])
DROP, SUMMARY, OPEN = 0, 1, 2


def keyed(docs: DataFrame) -> DataFrame:
    """did and th name a row: equal rows share them, and get equal results."""
    return id_and_text(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("did"), F.xxhash64("text").alias("th"), "text")


def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line with a key: 128-bit hash of the key, document, position."""
    for batch, texts in slices(batches):
        rows, pos, digests = [], [], []
        for i, t in enumerate(texts):
            for p, line in enumerate((t or b"").split(b"\n")):
                if key := line.strip(SPACE_BYTES):
                    digests.append(xxhash.xxh3_128_digest(key.lower()))
                    rows.append(i)
                    pos.append(p)
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        at = np.array(rows, np.int64)
        yield batch_of(POSTING, h1=h[:, 0], h2=h[:, 1], did=batch.column(0).to_numpy()[at], th=batch.column(1).to_numpy()[at], pos=np.array(pos, np.int32))


class Runs:
    """Streams a partition's sorted rows. A run is the rows of one hash.

    Rows of runs with `least` documents go out as DROP. A partition's first and last run may go on in
    its neighbours: their counts go out as SUMMARY, and their rows, while below `least`, as OPEN (so
    fewer than `least` documents each). Held rows are those of one run below `least`.
    """

    def __init__(self, least: int, part: int):
        self.least, self.part = least, part
        self.held = [np.zeros(0, np.int64)] * 5
        self.key: tuple | None = None  # of the run that is open and has reached `least`
        self.docs, self.last_doc = 0, None
        self.first_run = True
        self.summaries: list[tuple] = []

    def out(self, kind: int, cols: list, head: np.ndarray) -> pa.RecordBatch:
        n = len(cols[0])
        return batch_of(STREAMED, kind=np.full(n, kind, np.int8), **dict(zip(KEYS, cols, strict=True)) | {"pos": cols[4].astype(np.int32)}, n=np.zeros(n, np.int64), head=head, part=np.full(n, self.part, np.int32))

    def close_run(self, key: tuple, docs: int, last: bool) -> None:
        if self.first_run or last:
            self.summaries.append((*key, docs))
        self.first_run = False

    def feed(self, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if self.key is not None:
            other = np.flatnonzero((cols[0] != self.key[0]) | (cols[1] != self.key[1]))
            n = int(other[0]) if len(other) else len(cols[0])
            if n:
                own = [c[:n] for c in cols]
                self.docs += int((np.diff(own[2]) != 0).sum()) + int(own[2][0] != self.last_doc)
                self.last_doc = own[2][-1]
                yield self.out(DROP, own, np.zeros(n, bool))
                cols = [c[n:] for c in cols]
            if len(other):
                self.close_run(self.key, self.docs, False)
                self.key = None
        cols = [np.concatenate(x) for x in zip(self.held, cols, strict=True)]
        self.held = [c[:0] for c in cols]
        if not len(cols[0]):
            return
        fresh = np.append(True, (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0))
        start = np.flatnonzero(fresh)
        new_doc = fresh | np.append(True, np.diff(cols[2]) != 0)
        docs = np.add.reduceat(new_doc.astype(np.int64), start)
        end = np.append(start[1:], len(fresh))
        frequent = docs >= self.least
        if self.first_run and len(start) > 1:
            key = (cols[0][0], cols[1][0])
            self.close_run(key, int(docs[0]), False)
            if not frequent[0]:
                yield self.out(OPEN, [c[: end[0]] for c in cols], np.arange(end[0]) == 0)
            else:
                yield self.out(OPEN, [c[:1] for c in cols], np.ones(1, bool))
                yield self.out(DROP, [c[1 : end[0]] for c in cols], np.zeros(end[0] - 1, bool))
            frequent[0] = False
        elif self.first_run and frequent[0]:  # the only run so far
            yield self.out(OPEN, [c[:1] for c in cols], np.ones(1, bool))
            yield self.out(DROP, [c[1:] for c in cols], np.zeros(len(fresh) - 1, bool))
            self.key, self.docs, self.last_doc = (cols[0][0], cols[1][0]), int(docs[0]), cols[2][-1]
            return
        if frequent.any():
            rows = np.repeat(frequent, end - start)
            yield self.out(DROP, [c[rows] for c in cols], fresh[rows])
        if frequent[-1]:
            self.key, self.docs, self.last_doc = (cols[0][-1], cols[1][-1]), int(docs[-1]), cols[2][-1]
        elif len(start) > 1 or not frequent[0]:
            self.held = [c[start[-1] :].copy() for c in cols]

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.key is not None:
            self.close_run(self.key, self.docs, True)
        elif len(self.held[0]):
            n = len(self.held[0])
            self.close_run((self.held[0][0], self.held[1][0]), 1 + int((np.diff(self.held[2]) != 0).sum()), True)
            yield self.out(OPEN, self.held, np.arange(n) == 0)
        if self.summaries:
            h1, h2, n = (np.array(x, np.int64) for x in zip(*self.summaries, strict=True))
            zero = np.zeros(len(n), np.int64)
            yield batch_of(STREAMED, kind=np.full(len(n), SUMMARY, np.int8), h1=h1, h2=h2, did=zero, th=zero, pos=zero.astype(np.int32), n=n, head=zero.astype(bool), part=np.full(len(n), self.part, np.int32))


def streamed(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    runs = Runs(least, context.partitionId() if context else 0)
    for b in batches:
        yield from runs.feed([b.column(k).to_numpy().astype(np.int64) for k in range(5)])
    yield from runs.close()


def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dropped positions as zlib-compressed keep bits, up to the last dropped line; later lines stay."""
    schema = pa.schema([("did", pa.int64()), ("th", pa.int64()), ("n_dropped", pa.int64()), ("keep_bitmap", pa.binary())])
    for b in batches:
        packed, counts = [], []
        for dropped in b.column(2).to_pylist():
            keep = np.ones(max(dropped) // 8 * 8 + 8, bool)  # whole bytes, so that padding keeps
            keep[dropped] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
            counts.append(len(dropped))
        yield batch_of(schema, did=b.column(0), th=b.column(1), n_dropped=counts, keep_bitmap=packed)


def line_bitmaps(rows: DataFrame, min_docs: int, keep_first: bool = False) -> DataFrame:
    """For `keyed` rows that lose lines: did, th, n_dropped, keep_bitmap.

    A hash of a third of all lines is spread over many ranges, as the ranges are of hash and document.
    Partition-crossing runs are settled by their counts: two rows for each partition at most.
    """
    dealt = map_arrow(rows, postings, "h1 long, h2 long, did long, th long, pos int").repartitionByRange("h1", "h2", "did").sortWithinPartitions(*KEYS)
    found = map_arrow(dealt, lambda b: streamed(b, min_docs), "kind byte, h1 long, h2 long, did long, th long, pos int, n long, head boolean, part int")
    totals = found.filter(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min("part").alias("first_part"))
    open_rows = found.filter(F.col("kind") == OPEN).join(totals, ["h1", "h2"]).filter(F.col("total") >= min_docs)
    sure = found.filter(F.col("kind") == DROP)
    if keep_first:
        open_rows = open_rows.filter(~(F.col("head") & (F.col("part") == F.col("first_part"))))
        sure = sure.filter(~F.col("head"))
    dropped = sure.select("did", "th", "pos").unionByName(open_rows.select("did", "th", "pos"))
    lists = dropped.groupBy("did", "th").agg(F.collect_set("pos").alias("pos"))
    return map_arrow(lists, bitmaps, "did long, th long, n_dropped long, keep_bitmap binary")


def kept_lines(text: bytes, bitmap: bytes | None) -> bytes:
    if bitmap is None:
        return text
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8)).tolist()
    return b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i >= len(keep) or keep[i])


def line_dedup(docs: DataFrame, min_docs: int = 10, keep_first: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row for each document: doc_id, th (hash of the text), text, n_lines, n_dropped, keep_bitmap (null: all stay), carried.

    A line's key is the line stripped of white space, A-Z lower-cased. Keys of one character at least in
    `min_docs` documents (by doc_id; null ids count as one document) lose their lines everywhere, or
    with `keep_first` all but the first one by doc_id and position. Blank lines stay. A null text is one
    empty line. Repeated rows get equal results. `carried` is a struct of the columns named by `carry`; other
    columns are not read. An empty table gives an empty result. Texts of any length are cut in lines row by row, and their lines
    leave as hashes; a bitmap has a bit a line. Several texts of one id are told apart by th. `kept_text` applies the bitmaps.
    """
    ids = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), F.xxhash64(F.col("text").cast("string")).alias("th"), F.col("text").cast("string").alias("text")]
    rows = docs.select(*ids, F.struct(*[F.col(c) for c in carry] or [F.lit(None).cast("string").alias("none")]).alias("carried"))
    lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))), F.lit(0)) + 1
    found = rows.join(line_bitmaps(keyed(docs), min_docs, keep_first), ["did", "th"], "left")
    return found.select(F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "th", "text", lines.cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).alias("n_dropped"), "keep_bitmap", "carried")


def kept_text(found: DataFrame) -> DataFrame:
    """line_dedup's rows as doc_id, th, n_lines, n_dropped, carried, kept: the lines that stay, joined by \\n."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in slices(batches):
            kept = [kept_lines(t or b"", m) for t, m in zip(texts, b.column(5).to_pylist(), strict=True)]
            columns = {k: b.column(b.schema.get_field_index(k)) for k in ("doc_id", "th", "n_lines", "n_dropped", "carried")}
            yield pa.RecordBatch.from_arrays([*columns.values(), pa.array([k.decode() for k in kept], pa.string())], names=[*columns, "kept"])

    return map_arrow(found, apply, f"doc_id long, th long, n_lines long, n_dropped long, carried {found.schema['carried'].dataType.simpleString()}, kept string")
