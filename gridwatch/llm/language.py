"""Language ID: multinomial naive Bayes over hashed character n-grams, scored in numpy batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwatch.llm.common import batch_of, crc_mod, map_arrow, materialize, slices

BUCKETS, ORDERS, PRIOR_COUNT = 1 << 15, (2, 3), 0.5
#: A language is a row of the broadcast matrix (256 KB). More languages than this are scored in blocks of about half as many.
MAX_LANGUAGES = 256
#: Languages whose counts a task holds; beyond them they go out and start anew.
HELD_LANGUAGES = 64
FOLDS, HELD_OUT = 4, 2
LETTER = regex.compile(r"\p{L}")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def grams(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each n-gram of the texts' lower-cased code points."""
    chars = [np.frombuffer(t.decode().lower().encode("utf-32-le"), np.uint32) for t in texts]
    sizes = np.fromiter(map(len, chars), np.int64, len(chars))
    code = np.concatenate(chars) if chars else np.zeros(0, np.uint32)
    code = np.where((code >= 9) & (code <= 13), np.uint32(32), code).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    found, owner = [], []
    for n in ORDERS:
        if len(code) < n:
            continue
        h = np.zeros(len(code) - n + 1, np.uint64)
        for j in range(n):
            h = (h + code[j : len(code) - n + 1 + j] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        own = doc[: len(h)] == doc[n - 1 :]
        found.append(((h >> np.uint64(20)) & np.uint64(buckets - 1)).astype(np.int32)[own])
        owner.append(doc[: len(h)][own])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(found), np.concatenate(owner)


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each task's counts by language and bucket (-1: documents); a pair may come more than once."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
    counts: dict[str, np.ndarray] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for lang, row in counts.items():
            at = np.flatnonzero(row)
            yield batch_of(schema, lang=[lang] * len(at), bucket=np.where(at == BUCKETS, -1, at).astype(np.int32), n=row[at])
        counts.clear()

    for batch, texts in slices(batches, most=1 << 19):
        langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for lang in set(langs):
            own = [t or b"" for t, x in zip(texts, langs, strict=True) if x == lang]
            if lang not in counts and len(counts) >= HELD_LANGUAGES:
                yield from told()
            row = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            row[:BUCKETS] += np.bincount(grams(own)[0], minlength=BUCKETS)
            row[BUCKETS] += len(own)
    yield from told()


@dataclass
class LanguageModel:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def logs(self, texts: list[bytes]) -> np.ndarray:
        bucket, doc = grams(texts)
        logs = np.empty((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            logs[:, k] = np.bincount(doc, self.weights[k][bucket], len(texts)) + self.prior[k]
        return logs

    def predict(self, texts: list[bytes]) -> list[tuple[str, float]]:
        logs = self.logs(texts)
        best = logs.argmax(axis=1)
        score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        return [(self.languages[b], float(s)) for b, s in zip(best, score, strict=True)]


def fit(train: DataFrame, rows: int | None = None) -> LanguageModel:
    """Counts over all training rows (text, lang) of MAX_LANGUAGES languages or so; the matrix has a row for each. Priors are shares of `rows`, else of these rows."""
    table = map_arrow(train.select("text", "lang"), gram_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, at = np.unique(np.array(table["lang"].to_pylist(), object).astype(str), return_inverse=True) if table.num_rows else ([], None)
    if not len(names):
        return LanguageModel([], np.zeros(0), np.zeros((0, BUCKETS)))
    counts = np.zeros((len(names), BUCKETS + 1))
    counts[at, table["bucket"].to_numpy()] = table["n"].to_numpy()
    seen, docs = counts[:, :BUCKETS] + PRIOR_COUNT, counts[:, -1]
    return LanguageModel([str(x) for x in names], np.log(docs / (docs.sum() if rows is None else rows)), np.log(seen / seen.sum(axis=1, keepdims=True)))


#: What is known of a document after some blocks: the best log-probability, its language, and the log of all probabilities' sum.
CARRIED = "doc_id long, text string, held_out boolean, best double, lang_pred string, whole double"


def by_blocks(base: DataFrame, train: DataFrame, blocks: int) -> DataFrame:
    """`language_id` for any number of languages: dealt to `blocks` by hash, and each block's matrix is broadcast to a pass of its own.

    A pass carries a document's best language and sum of probabilities on, and is written before the next one.
    """
    spark, rows = base.sparkSession, train.count()
    now = base.select("doc_id", "text", "held_out", F.lit(float("-inf")).alias("best"), F.lit("und").alias("lang_pred"), F.lit(float("-inf")).alias("whole"))
    for k in range(blocks):
        told = spark.sparkContext.broadcast(fit(train.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == k), rows))

        def add(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            model = told.value
            for batch, texts in slices(batches, most=1 << 17):
                best, names, whole = (list(batch.column(batch.schema.get_field_index(c)).to_pylist()) for c in ("best", "lang_pred", "whole"))
                can = [i for i, t in enumerate(texts) if t and model.languages and LETTER.search(t.decode())]
                if can:
                    logs = model.logs([texts[i] for i in can])
                    top, sums = logs.argmax(axis=1), np.logaddexp.reduce(logs, axis=1)
                    for i, j, total, row in zip(can, top, sums, logs, strict=True):
                        whole[i] = float(np.logaddexp(whole[i], total))
                        if (-row[j], model.languages[j]) < (-best[i], names[i]):
                            best[i], names[i] = float(row[j]), model.languages[j]
                columns = {"best": best, "lang_pred": names, "whole": whole}
                yield pa.RecordBatch.from_arrays([pa.array(columns[c], batch.schema.field(c).type) if c in columns else batch.column(i) for i, c in enumerate(batch.schema.names)], schema=batch.schema)

        now = materialize(map_arrow(now, add, CARRIED), "languages")
    return now.select("doc_id", "held_out", "lang_pred", F.when(F.col("best") == float("-inf"), 0.0).otherwise(F.exp(F.col("best") - F.col("whole"))).alias("score"))


def language_id(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """A row for each document: doc_id, held_out, lang_pred, score (the posterior, 0 to 1).

    Learns from every row whose crc32(doc_id) mod `folds` is not `held_out` and whose lang is not null
    (a null text counts as an empty one). Predictions use the text only. Without text or a letter, or
    with nothing to learn from: `und` with score 0. Repeated rows each get a row. Ties go to the
    language first in order. More than MAX_LANGUAGES distinct languages are scored in blocks, with the same result. Very long texts
    only take time. Other columns are not read; an empty table gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    base = base.withColumn("held_out", crc_mod("doc_id", folds) == held_out)
    train = base.filter(~F.col("held_out") & F.col("lang").isNotNull())
    found = train.select("lang").distinct().count()
    if found > MAX_LANGUAGES:
        return by_blocks(base, train, -(-found // (MAX_LANGUAGES // 2)))
    model = fit(train)
    told = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, most=1 << 19):
            can = [bool(t) and bool(told.value.languages) and bool(LETTER.search(t.decode())) for t in texts]
            said = iter(told.value.predict([t for t, ok in zip(texts, can, strict=True) if ok]) if any(can) else ())
            lang, score = zip(*[next(said) if ok else ("und", 0.0) for ok in can], strict=True)
            yield batch_of(SCHEMA, doc_id=batch.column(0), held_out=batch.column(2), lang_pred=lang, score=score)

    return map_arrow(base.select("doc_id", "text", "held_out"), predict, "doc_id long, held_out boolean, lang_pred string, score double")
