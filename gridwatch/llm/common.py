"""What the text operators share: shared-folder tables, Arrow batches, word spans and word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwatch.sources.shared import materialize as materialize

#: The white space that separates words, as bytes.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
#: The same class for Spark's regular expressions.
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACE_BYTES)] = True
#: Bytes that separate terms: all ASCII but letters and digits.
NOT_TERM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long) and text (string) only, so that extra columns never clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def crc_mod(column: str, m: int):
    """crc32 of the column's text, modulo m; null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(m))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Parts of the batches with about `most` bytes of text each (one row at least), with the texts as bytes or None."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(text)).cast(pa.binary()).to_pylist()
        start = size = 0
        for i, v in enumerate(values):
            size += len(v or b"")
            if size >= most:
                yield batch.slice(start, i + 1 - start), values[start : i + 1]
                start, size = i + 1, 0
        if start < len(values):
            yield batch.slice(start), values[start:]


def map_arrow(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    return df.mapInArrow(work, schema)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base's first n powers and their inverses, modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        p, q = np.full(size, _BASE), np.full(size, _BASE_INV)
        p[0] = q[0] = 1
        _powers, _inverses = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _powers[:n], _inverses[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some texts: spans, documents and 64-bit hashes, all in numpy. `space` tells the bytes between words (with \\n).

    buf: the texts' bytes, separated by \\n; start, end: each word's span in buf;
    doc: each word's text number; first: number of each text's first word, with the total at the end.
    """

    def __init__(self, texts: list, lower: bool = False, space: np.ndarray = IS_SPACE):
        texts = [t or b"" for t in texts]
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = TO_LOWER[self.buf]
        space = space[self.buf]
        edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.text_end = np.cumsum(lengths)
        self.text_start = self.text_end - lengths
        self.first = np.searchsorted(self.start, np.append(self.text_start, len(self.buf)))
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hashes(self, *heads: int) -> np.ndarray:
        """Of the words, or with `heads` a row for each: of the words' first so many bytes."""
        if not len(self.start):
            return np.zeros((len(heads), 0) if heads else 0, np.uint64)
        p, q = powers(len(self.buf) + 1)
        sums = np.zeros(len(self.buf) + 1, np.uint64)
        np.cumsum(_BYTE[self.buf] * p[:-1], out=sums[1:])
        of = lambda end: mix((sums[end] - sums[self.start]) * q[self.start])
        return np.array([of(np.minimum(self.start + n, self.end)) for n in heads]) if heads else of(self.end)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words that start at each position; the last n-1 positions give none."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    p, q = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * p[:-1], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * q[: len(words) - n + 1])


def inside(w: Words, n: int) -> np.ndarray:
    """Positions of the n-word windows that lie within one text."""
    total = len(w.start)
    if total < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(w.doc[: total - n + 1] == w.doc[n - 1 :])
