"""Repeated rows, several texts of one id, very long texts and many languages, against plain loops."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from gridwatch.llm import language
from gridwatch.llm.language import language_id
from gridwatch.llm.leaks import leaks
from gridwatch.llm.lines import kept_text, line_dedup
from gridwatch.llm.neardup import near_duplicates
from gridwatch.llm.quality import quality_rules
from gridwatch.llm.shards import consistent_shards
from gridwatch.llm.substrings import substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, h long, th long, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 2, "k") for i, t in rows], SCHEMA)


def removed_by_loops(rows):
    """op1: kept words of each row."""
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 49):
            key = hashlib.md5(" ".join(w[k : k + 50]).encode()).digest()
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - 49):
            if first[hashlib.md5(" ".join(w[k : k + 50]).encode()).digest()] < i:
                gone.update(range(k, k + 50))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def rows_of(seed):
    """A text of 110,000 words that holds others' passages, copies under one id, two texts under one id, repeated rows."""
    draw = random.Random(seed)
    words = lambda n: [f"w{draw.randrange(50_000)}" for _ in range(n)]
    passage = words(80)
    long = words(110_000)
    long[5000:5000] = passage
    text = lambda n: " ".join(words(n))
    one, two = text(120), text(90) + "\nSHARED line\n" + " ".join(passage)
    return [(1, " ".join(long)), (2, two), (2, two), (2, one), (3, one), (3, one), (4, " ".join(passage[:60]) + " " + text(30)), (5, None), (5, ""), (5, text(10))]


def test_substrings_of_odd_rows(spark):
    rows = rows_of(1)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(frame(spark, rows)).collect())
    assert got == removed_by_loops(rows)
    assert substring_dedup(frame(spark, [])).count() == 0


def test_near_duplicates_of_odd_rows(spark):
    rows = [*rows_of(2), (9, rows_of(2)[0][1] + " more words at the end here")]
    sets = []
    for i, t in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = {k: {k} for k in range(len(rows))}
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                joined = comp[a] | comp[b]
                for k in joined:
                    comp[k] = joined
    want = sorted((i, len(s), min(rows[k][0] for k in comp[n])) for n, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))
    got = near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_lines_of_odd_rows(spark):
    rows = [*rows_of(3), *[(20 + k, "shared LINE \nown " + str(k)) for k in range(9)], (30, "\n".join(f"line {k}" for k in range(150_000)) + "\n shared line")]
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders.setdefault(x.strip(" \t\n\x0b\x0c\r").lower(), set()).add(i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if not ((key := x.strip(" \t\n\x0b\x0c\r").lower()) and len(holders[key]) >= 10)]
        want.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    got = kept_text(line_dedup(frame(spark, rows))).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == sorted(want)
    assert sum(r.n_dropped for r in got) >= 10


def test_shards_of_repeated_rows(spark):
    rows = [*rows_of(4), *[(7, f"t{k}") for k in range(50)], (None, "x"), (None, "x")]
    got = consistent_shards(frame(spark, rows)).collect()
    assert len(got) == len(rows) and len({r.shard for r in got if r.doc_id == 7}) == 1
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))


def test_leaks_with_clashing_columns(spark):
    item = " ".join(f"q{k}" for k in range(30))
    bench = spark.createDataFrame([(1, item, 5, "t"), (1, item, 6, "t")], "item_id long, text string, doc_id long, th string")
    got = leaks(frame(spark, [(1, "before " + item + " after"), (2, "nothing of it here at all"), (1, "before " + item + " after")]), bench).collect()
    assert [(r.doc_id, r.item_id, r.start) for r in got] == [(1, 1, 1)] * 2  # repeated documents once, repeated items each


def test_long_texts_are_judged_whole(spark):
    draw = random.Random(6)
    text = " ".join(f"w{draw.randrange(10**6)}" for _ in range(120_000))
    rows = quality_rules(frame(spark, [(1, text), (2, text + " " + " ".join(["again"] * 60_000))])).collect()
    assert {r.doc_id: (r.n_words, r.base_failed) for r in rows} == {1: (120_000, False), 2: (180_000, True)}
    said = language_id(spark.createDataFrame([(1, "le chat " * 60_000, "fr"), (3, "the cat " * 60_000, "en"), (4, "le chat " * 60_000, None)], "doc_id long, text string, lang string")).collect()
    assert {r.doc_id: r.lang_pred for r in said} == {1: "fr", 3: "en", 4: "fr"}


def test_many_languages_in_blocks(spark, monkeypatch):
    """Blocks of languages give what one matrix gives; more languages than a matrix holds are no error."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("lang", F.concat_ws("-", "lang", (F.col("doc_id") % 9).cast("string")))
    rows = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([(1000, None, "en-0"), (1001, "12 34", None)], "doc_id long, text string, lang string"))
    whole = sorted(map(tuple, language_id(rows).collect()))
    monkeypatch.setattr(language, "MAX_LANGUAGES", 10)
    parts = sorted(map(tuple, language_id(rows).collect()))
    assert [r[:3] for r in parts] == [r[:3] for r in whole] and all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(parts, whole, strict=True))
    assert len({r[2] for r in whole}) > 10
