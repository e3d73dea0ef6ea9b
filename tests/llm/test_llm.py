"""The text operators against brute force on small frames: copies, ties, nulls, empty and long texts, extra columns."""

import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridwatch.llm import attention, queries, scoring
from gridwatch.llm.count_tokens import PairCounter
from gridwatch.llm.count_tokens import token_counts
from gridwatch.llm.encode import TrieEncoder, Vocabulary, bpe_decode, bpe_encode
from gridwatch.llm.language import language_id
from gridwatch.llm.lines import DROP, OPEN, SUMMARY, Runs, kept_text, line_dedup
from gridwatch.llm import leaks as leak_module
from gridwatch.llm.leaks import leaks
from gridwatch.llm.neardup import near_duplicates
from gridwatch.llm.oracle import ORACLE_SQL
from gridwatch.llm.quality import BANDS, quality_kept, quality_rules
from gridwatch.llm.shards import consistent_shards
from gridwatch.llm.substrings import substring_dedup

DATA = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = ["", "  a  b \n c", "foo\n\n bar  ", "a<|endoftext|>b <|endoftext|>", "İstanbul ΣΑΣ ﬁ é é  x　y", "a\x1cb c", "don't we'll 'S 12345 ½ 中文 😀😀", "a" * 5000, "\t\ta\r\nb", "<|startoftext|>Hi<|endoftext|>there", " \n "]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def frame(spark, rows):
    """With columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, th long, pos string")


def corpus(seed=0):
    """Random documents with copies, near copies, shared passages, short, empty and null ones."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeABC", k=draw.randint(1, 4)))
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(60):
        kind = draw.randrange(6)
        w = [word() for _ in range(draw.randint(60, 160))]
        if kind == 0 and rows:
            rows.append((i, draw.choice(rows)[1]))
            continue
        if kind == 1 and rows:
            w = (draw.choice(rows)[1] or "a b").split()
            w[len(w) // 2] = word()
        if kind == 2:
            w[10:10] = passage[: draw.randint(45, 70)]
        rows.append((i, " ".join(w[:30]) + "\nSame Line \n" + " ".join(w[30:])))
    return rows + [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "One  two"), (None, "one two")]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA).toArrow(), con.sql(ORACLE_SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    cut = lambda v: round(v, 9) if isinstance(v, float) else v
    rows = lambda t: sorted(str(tuple(map(cut, r))) for r in zip(*[t.column(c).to_pylist() for c in columns], strict=True))
    assert rows(got) == rows(want)


def test_tokens_equal_the_library():
    draw = random.Random(1)
    texts = ODD + ["".join(draw.choices("abcdefgh  \n\t'.,!?0123éß中 ", k=60)) for _ in range(300)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert list(map(PairCounter(path).count, texts)) == [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    vocabulary = Vocabulary(path)
    ids, told = TrieEncoder(vocabulary).encode(texts), library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(i, "<u4").tolist() for i in ids] == [e.ids for e in told]
    assert vocabulary.decode([*ids, None]).to_pylist() == [library.decode(e.ids, skip_special_tokens=False) for e in told] + [None]
    small = TrieEncoder(vocabulary, chunks=8)  # its caches start anew all the time
    marked = ["g h <|endoftext|> i j k l", "m <|endoftext|> n o p q r s", *texts, "g <|startoftext|><|endoftext|> h"]
    for k in range(0, len(marked), 2):
        got = [np.frombuffer(i, "<u4").tolist() for i in small.encode(marked[k : k + 2])]
        assert got == [e.ids for e in library.encode_batch(marked[k : k + 2], add_special_tokens=False)]
    long = "".join(draw.choices("abcdefgh", k=100_000))
    assert np.frombuffer(small.encode([long])[0], "<u4").tolist() == library.encode(long, add_special_tokens=False).ids
    assert max(map(len, [*small.young, *small.old, ""])) <= len(long) and long not in small.old


def test_tokens_of_tables(spark):
    """Null, empty, odd and repeated rows, extra columns, and no rows at all, against the library."""
    rows = [(i, t) for i, t in enumerate(ODD * 2)] + [(None, "a b"), (7, None), (7, None), (8, "x" * 20_000)]
    library = Tokenizer.from_file(path := public_tokenizers.path("word_bpe_49k.json"))
    found = bpe_encode(frame(spark, rows), path)
    text = {r.doc_id: r.decoded for r in bpe_decode(found.withColumnRenamed("doc_id", "id"), path, "id").collect()}
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert text == {i: d for i, _, _, d in want}
    library = Tokenizer.from_file(path := public_tokenizers.path("byte_bpe_50k.json"))
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(tuple, token_counts(frame(spark, rows), path).collect()), key=str) == sorted(want, key=str)
    empty, words = frame(spark, []), public_tokenizers.path("word_bpe_49k.json")
    assert bpe_encode(empty, words).count() == bpe_decode(bpe_encode(empty, words), words).count() == token_counts(empty, path).count() == 0


def test_languages(spark):
    """Held-out accuracy, and rows without text, letters or language."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    said = language_id(docs).alias("s").join(docs.alias("d"), "doc_id").filter("s.held_out and d.lang is not null and lang_pred <> 'und'").select("lang", "lang_pred", "score").collect()
    assert len(said) > 20 and sum(r.lang == r.lang_pred for r in said) >= 0.97 * len(said)
    assert all(0 <= r.score <= 1 for r in said)
    rows = [(1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (4, "the dog", None), (5, None, "en"), (6, "", "en"), (7, "12 34 !", "de"), (8, "der hund " * 5000, "de"), (8, "der hund " * 5000, "de"), (None, "the", "en")]
    got = language_id(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, score string, bucket int")).collect()
    assert len(got) == len(rows) and all(r.lang_pred in ("en", "de", "und") for r in got)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {5, 6, 7} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert language_id(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert {r.lang_pred for r in language_id(spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")).collect()} == {"und"}


@pytest.mark.parametrize("seed", [0, 1])
def test_substrings(spark, seed):
    rows = corpus(seed)
    first = {}
    for i, t in sorted((-1 if i is None else i, t) for i, t in rows if t):
        w = WORD.findall(t)
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(50)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert sorted(map(tuple, substring_dedup(frame(spark, rows)).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates(spark, seed):
    rows = corpus(seed)
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    low = lambda i: -1 if i is None else i
    comp = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                    comp[a] = min(comp[a], comp[b], key=low)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (len(s), comp[i], comp[i] == i) for i, s in sets.items()}


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines(spark, keep_first):
    rows = corpus(2)
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    lines = {i: (t or "").split("\n") for i, t in rows}
    docs, first = {}, {}
    for i in sorted(lines, key=lambda i: -1 if i is None else i):
        for p, x in enumerate(lines[i]):
            docs.setdefault(key(x), set()).add(i)
            first.setdefault(key(x), (i, p))
    drop = lambda i, p, x: key(x) and len(docs[key(x)]) >= 5 and not (keep_first and first[key(x)] == (i, p))
    want = {i: (len(ls), "\n".join(x for p, x in enumerate(ls) if not drop(i, p, x))) for i, ls in lines.items()}
    got = kept_text(line_dedup(frame(spark, rows), 5, keep_first)).collect()
    assert {r.doc_id: (r.n_lines, r.kept) for r in got} == want
    assert all(r.n_dropped == r.n_lines - (len(r.kept.split("\n")) if r.kept or r.n_dropped < r.n_lines else 0) for r in got)


def test_runs_over_any_cut():
    for trial in range(400):
        draw = random.Random(trial)
        rows = sorted({(draw.choice([1, 1, 1, 2, 3, 4]), 0, draw.randrange(12), 0, draw.randrange(3)) for _ in range(draw.randrange(1, 60))})
        parts, least = [[]], draw.choice([2, 3, 5])
        for i, r in enumerate(rows):
            if i and (r[0], r[2]) != (rows[i - 1][0], rows[i - 1][2]) and draw.random() < 0.15:
                parts.append([])
            parts[-1].append(r)
        out = []
        for p, part in enumerate(parts):
            runs = Runs(least, p)
            for k in range(0, len(part), 4):
                out += [x for y in runs.feed([np.array([r[c] for r in part[k : k + 4]], np.int64) for c in range(5)]) for x in y.to_pylist()]
            out += [x for y in runs.close() for x in y.to_pylist()]
        total, docs = {}, {}
        for x in out:
            if x["kind"] == SUMMARY:
                total[x["h1"]] = total.get(x["h1"], 0) + x["n"]
        for r in rows:
            docs.setdefault(r[0], set()).add(r[2])
        got = {(x["h1"], x["did"], x["pos"]) for x in out if x["kind"] == DROP or (x["kind"] == OPEN and total[x["h1"]] >= least)}
        assert got == {(r[0], r[2], r[4]) for r in rows if len(docs[r[0]]) >= least}


def test_leaks_find_near_copies_at_any_place(spark):
    draw = random.Random(3)
    words = lambda n: ["".join(draw.choices("abcdefgh", k=5)) for _ in range(n)]
    item = words(60)
    edited = item[:30] + ["CHANGED"] + item[31:]
    rows = [(1, " ".join(words(40) + item + words(40))), (2, " ".join(words(7) + edited)), (3, " ".join(item[:58]).upper()), (4, " ".join(words(200))), (5, " ".join(item[:30])), (6, None), (7, "a b")]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, "a b"), (12, None), (None, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.start for r in leaks(frame(spark, rows), bench).collect()}
    assert got == {(d, i): s for d, s in ((1, 40), (2, 7), (3, 0)) for i in (10, None)}


def test_leaks_weigh_repeated_shingles(spark):
    """Copies that lack an item's run of one word are found at their weighted similarity."""
    draw, items, rows = random.Random(6), [], []
    for i, (distinct, times) in enumerate([(60, 8), (100, 14), (200, 28), (196, 14)] * 4):
        w = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(distinct + 4)]
        items.append((i, " ".join(w + ["_"] * (times + 4))))
        rows.append((i, " ".join(w)))
    split = lambda t: [" ".join(w) for w in zip(*(t.split()[k:] for k in range(5)))]
    want = {}
    for (i, t), (_, u) in zip(rows, items, strict=True):
        a, b = split(t), split(u)
        shared = sum(min(a.count(x), b.count(x)) for x in set(a))
        want[i, i] = shared / (len(a) + len(b) - shared)
    assert min(want.values()) >= 0.75
    got = {(r.doc_id, r.item_id): r.similarity for r in leaks(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_leaks_find_long_items_and_repeats(spark):
    draw = random.Random(9)
    item = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(2500)]
    rows = [(1, " ".join(item)), (2, " ".join(["x"] * 40 + item[:2000] + ["edit"] + item[2001:] + ["y"] * 30)), (3, " ".join(item[:1500])), (1, " ".join(item)), (1, " ".join(item[1:])), (None, " ".join(item))]
    bench = spark.createDataFrame([(10, " ".join(item))], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.start, r.n_words, r.similarity) for r in leaks(frame(spark, rows), bench).collect())
    assert got == [(0, 0, 2500, 1.0), (1, 0, 2499, 2495 / 2496), (1, 0, 2500, 1.0), (2, 40, 2500, 2491 / 2501)]
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks(frame(spark, rows), none).count() == leaks(frame(spark, []), bench).count() == 0


def test_hamming_blocks_find_all_within_the_radius(spark):
    draw = random.Random(4)
    prints = [draw.getrandbits(128) for _ in range(30)]
    near = [(k, sum(1 << b for b in draw.sample(range(128), draw.choice([0, 3, 46, 47, 48, 60]))) ^ p) for k, p in enumerate(prints)]
    half = lambda x: [v - (1 << 64) if v >> 63 else v for v in (x & (1 << 64) - 1, x >> 64)]
    items = spark.createDataFrame([(k, 9, *half(p)) for k, p in enumerate(prints)], "item long, n int, f0 long, f1 long")
    windows = spark.createDataFrame([(k, 9, *half(p)) for k, p in near] + [(99, 8, *half(prints[0]))], "w long, n int, f0 long, f1 long")
    got = {(r.w, r.item) for r in leak_module.within_radius(windows, items).collect()}
    assert got == {(w, k) for w, x in near for k, p in enumerate(prints) if (x ^ p).bit_count() <= 47}


def test_fingerprints_are_majorities(spark):
    draw = random.Random(5)
    sets = [[draw.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 7, 300)]
    got = {r.k: (r.f0, r.f1) for r in leak_module.fingerprints(spark.createDataFrame(list(enumerate(sets)), "k long, s array<long>"), ["k"], "s").collect()}
    for k, members in enumerate(sets):
        bits = sum(1 << b for b in range(64) if 2 * sum(m >> b & 1 for m in members) > len(members))
        assert got[k][0] % (1 << 64) == bits


def test_shards(spark):
    def jump(key, n):
        key, b, j = key % (1 << 64), -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    far = [-(1 << 62) - 5, (1 << 62) + 5, (1 << 63) - 1, -(1 << 63)]  # blocks don't depend on the spread of ids
    got = consistent_shards(frame(spark, [(i, "é" * (i % 3)) for i in [*range(-50, 300), *far]] + [(None, None)]), 24, 2).collect()
    assert len(got) == 355
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        text = "" if r.doc_id is None else "é" * (r.doc_id % 3)
        assert (r.shard, r.grown_shard, r.size, r.text_crc32) == (jump(key, 24), jump(key, 25), len(text.encode()) + 8, zlib.crc32(text.encode()))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_quality(spark):
    draw = random.Random(8)
    noise = "".join(draw.choices("".join(map(chr, range(33, 127))) + "  ", k=6000))  # its chunks don't shrink
    prose = [t for _, t in frame(spark, []).sparkSession.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()[:40]]
    rows = corpus(4) + [(200, "spam spam spam spam " * 100), (201, noise)] + [(300 + k, t) for k, t in enumerate(prose)]
    got = {r.doc_id: r for r in quality_rules(frame(spark, rows)).collect()}
    for i, t in rows:
        w, windows = WORD.findall(t or ""), {}
        for k in range(len(w) - 7):
            windows.setdefault(tuple(w[k : k + 8]), []).append(k)
        covered = {k + j for v in windows.values() if len(v) > 1 for k in v for j in range(8)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        b = (t or "").encode()
        parts = [b[k : k + 2048] for k in range(0, len(b), 2048)] if len(b) > 2048 else []
        if parts and len(parts[-1]) < 512:
            parts[-2:] = [parts[-2] + parts[-1]]
        parts = [b, *parts]
        ratios = [len(x) / max(1, len(zstandard.compress(x, 3))) for x in parts]
        limits = [max(x for x in BANDS if x[0] <= len(p))[1:] for p in parts]
        fine = bool(b) and all(low <= ratio <= high for ratio, (low, high) in zip(ratios, limits, strict=True))
        assert r.kept == (fine and not r.base_failed)
        assert not b or np.isclose(r.ratio, ratios[0])
    assert not got[200].kept and {True, False} == {r.kept for r in got.values() if not r.base_failed}
    kept = quality_kept(frame(spark, rows + rows[:3]))
    assert kept.columns == frame(spark, []).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in rows + rows[:3] if got[i].kept)
    assert quality_kept(frame(spark, [])).count() == 0


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert scoring.lm_scores(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    for f in (substring_dedup, near_duplicates, line_dedup, quality_rules, consistent_shards):
        assert f(empty).count() == 0


def test_attention_is_causal_and_scores_each_goal_once():
    model = attention.Model(None, None, np.zeros((attention.CLASSES, attention.CLASSES), np.float32), attention.start_weights())
    model.weights["U"] = np.random.default_rng(0).normal(size=model.weights["U"].shape).astype(np.float32)
    draw = np.random.default_rng(1)
    a = np.concatenate([[attention.END], draw.integers(0, 900, 100), [attention.END]])
    b = np.concatenate([a[:50], draw.integers(0, 900, 30), [attention.END]])
    goal = lambda s: attention.CLASS_OF[s[1:]]
    one, two = attention.class_scores(model, [a], [goal(a)]), attention.class_scores(model, [a, b], [goal(a), goal(b)])
    assert len(one) == 101 and len(two) == 101 + 80
    assert np.allclose(one[:49], two[101:150], atol=1e-5)
    first = attention.forward(model.weights, model.bigram, attention.windows([a], [goal(a)])[0][:1], attention.CONTEXT)[-1][0, 0]
    assert np.isclose(one[0], first[goal(a)[0]] - np.log(np.exp(first).sum()), atol=1e-4)
    some = np.where(np.arange(101) % 3 == 0, goal(a), -1)
    assert np.allclose(attention.class_scores(model, [a], [some]), one[::3], atol=1e-5)


def test_training_lowers_the_loss_and_weights_pack():
    draw = np.random.default_rng(2)
    turns = [np.concatenate([[attention.END], np.tile(draw.permutation(5), 12), [attention.END]]) for _ in range(40)]
    goals = [attention.CLASS_OF[s[1:]] for s in turns]
    flat, start = np.full((attention.CLASSES, attention.CLASSES), -np.log(attention.CLASSES), np.float32), attention.start_weights()
    after, n = attention.train(turns, goals, flat, start)
    score = lambda p: attention.class_scores(attention.Model(None, None, flat, p), turns, goals).mean()
    assert n == 120 and score(after) > score(start) + 2
    back = attention.unpacked(attention.packed(after))
    assert all((back[k] == x).all() for k, x in after.items())
    assert attention.train([], [], flat, start) == (start, 0)


def test_model_counts_cover_rows_outside_the_sample(spark):
    path, texts = public_tokenizers.path("byte_bpe_50k.json"), [t for _, t in corpus(4)] + ODD
    rows = scoring.keyed(frame(spark, list(enumerate(texts)))).repartition(3)
    counted = scoring.map_arrow(rows.select("text"), lambda b: scoring.word_counts(b, path), scoring.COUNTED)
    counted = counted.groupBy("kind", "w").agg(F.sum("c").alias("c"), F.min("first").alias("first"))
    model, norms = scoring.fit(rows, path, counted, len(texts), 2)
    told = Tokenizer.from_file(path)
    found = [[told.encode(" " + w, add_special_tokens=False).ids for w in re.findall(WORD, lower(t or ""))] for t in texts]
    ids = np.bincount([i for x in found for w in x for i in w], minlength=len(model.class_of))
    assert (model.class_of == attention.classes_of(attention.ranks_of(ids))).all()
    end = attention.CLASSES - 1
    pairs = np.full((attention.CLASSES, attention.CLASSES), 0.1)
    for x in found:
        before = end
        for w in x:
            pairs[before, model.class_of[w[0]]] += 1
            before = model.class_of[w[-1]]
        pairs[before, end] += 1
    assert np.allclose(model.bigram, np.log(pairs / pairs.sum(axis=1, keepdims=True)), atol=1e-5)
    words = [(w, model.class_of[i[0]]) for t, x in zip(texts, found) for w, i in zip(re.findall(WORD, lower(t or "")), x, strict=True)]
    want = [sum(k == c for _, k in words) + len({w for w, k in words if k == c}) + 1 for c in range(attention.CLASSES)]
    assert np.allclose(10**norms, want)


def test_every_training_row_trains_the_weights(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = scoring.keyed(frame(spark, [(i, t) for i, t in corpus(6) if t and len(t.split()) > 20][:6])).repartition(2, "did").cache()
    counted = scoring.map_arrow(rows.select("text"), lambda b: scoring.word_counts(b, path), scoring.COUNTED)
    counted = counted.groupBy("kind", "w").agg(F.sum("c").alias("c"), F.min("first").alias("first")).cache()
    weights = lambda some: attention.packed(scoring.fit(some, path, counted, 6, 1)[0].weights)
    whole, ids = weights(rows), [r.did for r in rows.select("did").collect()]
    assert len(ids) == 6
    for i in ids:
        assert np.abs(weights(rows.filter(F.col("did") != i)) - whole).max() > 1e-4


def test_rounds_deal_out_all_rows():
    assert scoring.round_ends(100, 2000) == [1.0] * scoring.ROUNDS and scoring.round_ends(0, 2000)[-1] == 1.0
    ends = scoring.round_ends(200_000, 2000)
    assert np.allclose(ends, [0.01, 0.1, 1]) and ends[-1] == 1.0


def test_gradients_are_the_loss_s_slopes():
    draw, p = np.random.default_rng(4), attention.start_weights()
    p["U"] = draw.normal(0, 0.1, p["U"].shape).astype(np.float32)
    seen, target, wanted = draw.integers(0, attention.INPUTS, (3, attention.WINDOW)), draw.integers(0, attention.CLASSES, (3, attention.STEP)), draw.random((3, attention.STEP)) < 0.4
    flat = np.full((attention.CLASSES, attention.CLASSES), -np.log(attention.CLASSES), np.float32)

    def loss(k, i, by):
        q = {n: x.astype(float) for n, x in p.items()}
        q[k][i] += by
        logits = attention.forward(q, flat, seen, attention.CONTEXT)[-1][wanted]
        return (np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(logits)), target[wanted]]).mean()

    for k, g in attention.gradients(p, flat, seen, target, wanted).items():
        for i in [np.unravel_index(np.abs(g).argmax(), g.shape), *zip(*(draw.integers(0, n, 3) for n in g.shape), strict=True)]:
            assert np.isclose(g[i], (loss(k, i, 1e-3) - loss(k, i, -1e-3)) / 2e-3, rtol=1e-3, atol=1e-6)


def test_each_window_is_trained_on_once_unless_there_are_too_few(monkeypatch):
    told = []
    monkeypatch.setattr(attention, "gradients", lambda p, b, seen, *_: told.append(seen[:, attention.CONTEXT]) or {k: np.zeros_like(x) for k, x in p.items()})
    parts = [([np.array([attention.END, *range(k, k + 96), attention.END])], [np.array([1] * 96 + [2])]) for k in (0, 300, 600)]
    start = [attention.END, 23, 47, 71, 95]
    want = sorted(start + [k + x for k in (300, 600) for x in start[1:]] + [attention.END] * 2)
    for steps, times in ((0, 1), (3, 1), (4, 2)):
        told.clear()
        assert attention.train_parts(parts, None, attention.start_weights(), steps)[1] == 15
        assert sorted(np.concatenate(told).tolist()) == sorted(want * times)


def test_words_tokenize_alike_alone_and_together():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, words = Tokenizer.from_file(path), ["don't", "'s", "<|endoftext|>", "a<|endoftext|>b", "éß", "中文", "x\u00a0y", "\u2028", "\u00a0", "12ab", "!?", "plain", "𝒳"]
    for part in (words, [w for w in words if w.split() == [w]]):
        got = [np.frombuffer(x, np.uint16).tolist() for x in scoring.tokenized([w.encode() for w in part], path)]
        assert got == [library.encode(" " + w, add_special_tokens=False).ids for w in part]


def test_a_worker_spells_each_of_its_words_once(monkeypatch):
    path, told, spell = public_tokenizers.path("byte_bpe_50k.json"), [], scoring.tokenized
    monkeypatch.setattr(scoring, "tokenized", lambda words, p: told.append(len(words)) or spell(words, p))
    scoring.cache.cache_clear()
    texts = [b" ".join(b"w%x" % i for i in range(k, k + 10_000)) for k in range(0, 450_000, 10_000)]
    once, again = ([scoring.distinct_words([t], path)[4:] for t in texts] for _ in range(2))
    for (ids, starts), (ids2, starts2) in zip(list(once), list(again), strict=True):
        assert (ids == ids2).all() and (starts == starts2).all()
    assert sum(told) == 450_000
    scoring.cache.cache_clear()


def test_spellings_are_the_library_s_whatever_is_kept(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, texts = Tokenizer.from_file(path), [t for _, t in corpus(8) if t] + ["x" * 3000 + " abE " + "longer" * 40, "", "abE zz\u00a0y abE", "z" * 70]
    for kept, ids in ((0, 1 << 20), (25, 1 << 20), (1 << 20, 40), (1 << 20, 1 << 20)):
        monkeypatch.setattr(scoring, "CACHE", kept)
        monkeypatch.setattr(scoring, "CACHED_IDS", ids)
        scoring.cache.cache_clear()
        for some in [texts[:5], texts[5:], texts[::-1], [None, ""], texts]:
            found, h, number, times, subs, starts = scoring.distinct_words([t and t.encode() for t in some], path)
            words = [lower(w) for t in some for w in re.findall(WORD, t or "")]
            assert len(number) == len(words) == times.sum() and len(set(words)) == len(h) == len(starts) - 1
            for w, i in zip(words, number.tolist(), strict=True):
                assert subs[starts[i] : starts[i + 1]].tolist() == library.encode(" " + w, add_special_tokens=False).ids
    scoring.cache.cache_clear()


def test_gradients_of_steep_weights_are_finite():
    draw, p = np.random.default_rng(5), attention.start_weights()
    seen, target, wanted = draw.integers(0, attention.INPUTS, (9, attention.WINDOW)), draw.integers(0, attention.CLASSES, (9, attention.STEP)), draw.random((9, attention.STEP)) < 0.4
    for scale in (1, 10, 100):
        p["U"] = draw.normal(0, scale, p["U"].shape).astype(np.float32)
        found = attention.gradients(p, np.full((attention.CLASSES, attention.CLASSES), -20, np.float32), seen, target, wanted)
        assert all(np.isfinite(g).all() for g in found.values()) and np.abs(found["U"]).max() > 0


def test_scores_beat_the_base_on_held_out_rows(spark):
    docs = spark.read.parquet(DATA.replace("0.001", "0.01") + "/documents.parquet")
    rows = scoring.lm_scores(docs, public_tokenizers.path("byte_bpe_50k.json")).filter("held_out").collect()
    mean = lambda c: sum(r[c] for r in rows) / sum(r.n_tokens for r in rows)
    print("held out, log10 a token: score", mean("score"), "base", mean("base_score"))
    assert len(rows) > 80 and mean("score") > mean("base_score")


def test_scores_are_those_of_all_words_whatever_the_head_holds(spark):
    path, rows = public_tokenizers.path("byte_bpe_50k.json"), [(i or 7, t) for i, t in corpus(5)] + [(3, "bad abE")] * 2 + [(9, "x" * 30_000 + " abE")]
    get = lambda head: sorted(map(tuple, scoring.lm_scores(frame(spark, rows), path, head_words=head).collect()))
    whole, some, none = get(1 << 20), get(20), get(0)
    assert len(whole) == len(some) == len(none) == len(rows)
    assert np.isfinite([x[5:] for x in whole]).all()
    for a, b, c in zip(whole, some, none, strict=True):
        assert a[:5] == b[:5] == c[:5] and np.allclose(a[5:], b[5:]) and np.allclose(a[5:], c[5:])
    learned = [lower(t or "") for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = {}
    for w in (w for t in learned for w in WORD.findall(t)):
        counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values()) + len(learned)
    texts, norm = {(i, len(WORD.findall(t or "")) + 1): lower(t or "") for i, t in rows}, np.log10(total + len(counts) + 2)
    for i, held, n, known, train, base, _ in some:
        w = WORD.findall(texts[i, n])
        assert (held, known, train) == (zlib.crc32(str(i).encode()) % 7 == 2, sum(x in counts for x in w) + 1, total)
        assert np.isclose(base, sum(np.log10(counts.get(x, 0) + 1) - norm for x in w) + np.log10(len(learned) + 1) - norm)


def test_pipeline_lines_stage_leaves_one_of_many_copies(spark):
    import corpus_pipeline

    rows = [(i, "one two\nthree four") for i in range(12)] + [(20, "one two\nown line"), (21, ""), (22, "own text")]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, frame(spark, rows), DATA).collect()}
    assert got == {0: "one two\nthree four", 20: "own line", 21: "", 22: "own text"}


def stage_rows():
    """Prose with copies, near copies, repeated rows, nulls, empty and long texts, and two texts under one id."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 8)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n // 12))
    rows = [(i, text(120)) for i in range(10)]
    near = rows[3][1].split(" ")
    near[40] = "changed"
    rows += [(20, rows[1][1]), (21, rows[1][1]), (22, " ".join(near)), (23, None), (24, ""), (25, "\n \n"), (26, text(24_000)), (27, "spam " * 300)]
    return rows + [rows[2], rows[2], (5, text(120)), (None, text(120)), (None, rows[4][1])]


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline as P

    rows = stage_rows()
    docs = frame(spark, rows)
    pairs = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    said = {(r.doc_id, r.text): r.kept for r in quality_rules(docs).collect()}
    assert pairs(P.quality(spark, docs, DATA)) == sorted([r for r in rows if said[r]], key=str)
    assert {(27, "spam " * 300), (23, None), (24, "")}.isdisjoint(pairs(P.quality(spark, docs, DATA)))

    sets = [(i, t, {tuple(w[k : k + 5]) for w in [WORD.findall(lower(t or ""))] for k in range(len(w) - 4)}) for i, t in dict.fromkeys(rows)]
    group = list(range(len(sets)))
    low = lambda i: -1 if i is None else i
    for a in range(len(sets)):
        for b in range(a):
            n = len(sets[a][2] & sets[b][2])
            if n and 100 * n >= 75 * (len(sets[a][2]) + len(sets[b][2]) - n):
                group = [group[b] if g == group[a] else g for g in group]
    got = pairs(P.near(spark, docs, DATA))
    left = {}
    for (i, t, s), g in zip(sets, group, strict=True):
        left.setdefault(g if s else (i, t), set()).add(i)
    assert sorted((low(i) for i, _ in got)) == sorted(low(min(x, key=low)) for x in left.values()) and set(got) <= set(rows)

    item = rows[7][1].split()[10:60]
    spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    clean = pairs(P.decontaminate(spark, docs, str(tmp_path)))
    assert clean == sorted([r for r in rows if r[0] != 7], key=str)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=str)
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in P.encode(spark, docs, DATA).collect()), key=str) == want

    for name, stage in P.STAGES:
        empty = stage(spark, frame(spark, []), DATA)
        assert empty.count() == 0 and (name == "bpe_encoding" or set(P.COLUMNS) <= set(empty.columns)), name


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    got = corpus_pipeline.run(spark, DATA)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    rows = got.collect()
    assert len({r.doc_id for r in rows}) == len(rows) > 50
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert all(library.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False) == r.decoded for r in rows)
