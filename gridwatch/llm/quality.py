"""Quality rules: zstandard ratios of whole documents and of fixed chunks against length-specific bands."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from gridwatch.llm.common import IS_SPACE, Words, batch_of, gram_hashes, id_and_text, inside, map_arrow, mix, slices

#: (bytes from, least ratio, most ratio). Ratio: bytes of text by bytes of its zstandard frame.
#: Prose gains with length, as the frame's overhead and the unseen start weigh less.
BANDS = (
    (0, 0.0, 1.45),
    (64, 0.75, 1.60),
    (128, 0.95, 1.95),
    (256, 1.15, 2.10),
    (512, 1.25, 2.25),
    (1024, 1.40, 2.45),
    (2048, 1.60, 2.60),
    (4096, 1.75, 2.85),
    (16384, 1.90, 3.30),
)
CHUNK, LEAST_CHUNK, LEVEL = 2048, 512, 3
MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Bytes that begin a character.
LEADS = (np.arange(256) & 0xC0) != 0x80

SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string())]
    + [(k, pa.int64()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("ratio", pa.float64()), ("chunk_ratio_min", pa.float64()), ("chunk_ratio_max", pa.float64())]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_())]
)
DDL = "doc_id long, text string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, chunk_ratio_min double, chunk_ratio_max double, base_failed boolean, kept boolean"


def band(n_bytes: int, bands: tuple = BANDS) -> tuple[float, float]:
    return next((low, high) for at, low, high in reversed(bands) if n_bytes >= at)


def compression(text: bytes, press: zstandard.ZstdCompressor, bands: tuple) -> tuple[float, float, float, bool]:
    """Whole ratio, least and most chunk ratio, and whether all lie in their bands."""
    if not text:
        return 0.0, 0.0, 0.0, False
    whole = len(text) / len(press.compress(text))
    low, high = band(len(text), bands)
    fine, seen = low <= whole <= high, []
    if len(text) > CHUNK:
        ends = [*range(CHUNK, len(text) - LEAST_CHUNK + 1, CHUNK), len(text)]  # a short last chunk belongs to the one before
        for chunk in (text[i:j] for i, j in pairwise([0, *ends])):
            seen.append(len(chunk) / len(press.compress(chunk)))
            low, high = band(len(chunk), bands)
            fine = fine and low <= seen[-1] <= high
    return whole, min(seen, default=whole), max(seen, default=whole), fine


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repeated_words(w: Words, n: int = REPEAT_WINDOW) -> np.ndarray:
    """For each text the words inside n-word windows that the text holds twice or more."""
    at = inside(w, n)
    if not len(at):
        return np.zeros(len(w.count), np.int64)
    key = mix(gram_hashes(w.hashes(), n)[at] + w.doc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(w.start) + n, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + n, -1)
    covered = np.cumsum(step)[: len(w.start)] > 0
    return np.bincount(w.doc[covered], minlength=len(w.count))


def judge(batches: Iterator[pa.RecordBatch], bands: tuple = BANDS) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=LEVEL)
    for batch, texts in slices(batches, most=1 << 18):
        w = Words(texts)
        total = lambda flags: np.add.reduceat(flags.astype(np.int64), w.text_start)
        repeats = repeated_words(w)
        seen = [compression(t or b"", press, bands) for t in texts]
        failed = (w.count < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * w.count)
        whole, least, most, fine = zip(*seen, strict=True)
        yield batch_of(
            SCHEMA,
            doc_id=batch.column(0),
            text=batch.column(1),
            n_words=w.count,
            word_chars=total(LEADS[w.buf] & ~IS_SPACE[w.buf]),
            n_symbols=total(SYMBOLS[w.buf]),
            n_dup_lines=[duplicate_lines(t or b"") for t in texts],
            n_repeat_words=repeats,
            ratio=whole,
            chunk_ratio_min=least,
            chunk_ratio_max=most,
            base_failed=failed,
            kept=~failed & np.array(fine),
        )


def quality_rules(docs: DataFrame, bands: tuple = BANDS) -> DataFrame:
    """A row for each document: its text, counts, ratios, `base_failed` and the verdict `kept`.

    One pass without a shuffle; the work for a document needs its text only. A text over 2,048 bytes is also
    judged by its chunks of 2,048 bytes; a last chunk under 512 bytes is joined to the one before. A null
    text counts as empty, and an empty one has no words and fails. Repeated rows each get their own row;
    other columns of `docs` are not read. An empty table gives an empty result.
    """
    return map_arrow(id_and_text(docs), lambda batches: judge(batches, bands), DDL)


def quality_kept(docs: DataFrame, bands: tuple = BANDS) -> DataFrame:
    """The rows of `docs`, with all their columns, that `quality_rules` keeps: one pass without a shuffle."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            pair = pa.RecordBatch.from_arrays([pa.nulls(batch.num_rows, pa.int64()), batch.column(at)], names=["doc_id", "text"])
            keep = [x.column(SCHEMA.get_field_index("kept")) for x in judge(iter([pair]), bands)]
            yield batch.filter(pa.chunked_array(keep, pa.bool_()).combine_chunks()) if keep else batch

    return docs.mapInArrow(kept, docs.schema)
