"""Hard negatives, ranked search and toxicity against brute force and by held-out accuracy."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from gridwatch.llm import negatives, ranked
from gridwatch.llm.negatives import hard_negatives
from gridwatch.llm.ranked import lexical_search
from gridwatch.llm.toxicity import segments, toxicity

DATA = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def negatives_by_loops(rows, every):
    known = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v])
        known[i] = min(known.get(i, one), one)
    out = []
    for a in (i for i in known if i % every == 0):
        score = {i: sum(x * y for x, y in zip(known[a][1], v, strict=False)) for i, (_, v) in known.items()}
        order = sorted(known, key=lambda i: (-score[i], i))
        for p in [i for i in order if i != a and known[i][0] == known[a][0]][:5]:
            fit = [i for i in order if known[i][0] != known[a][0] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fit)]
    return sorted(out)


def test_negatives_against_loops(spark):
    """Copies, ties, repeated ids, short, empty and vast vectors, nulls, not-a-numbers and rare labels."""
    draw = random.Random(3)
    vector = lambda n=6: [draw.gauss(0, 0.2) for _ in range(n)]
    same = vector()
    rows = [(i, same if i % 3 == 0 else vector(), i % 4) for i in range(300)]
    rows += [(300, vector(3), 1), (301, [], 2), (302, None, 1), (303, vector(), None), (304, [float("nan")] * 6, 1), (305, [float("inf"), *same[1:]], 2), (306, [None, *same[1:]], 2)]
    rows += [(None, same, 1), (8, vector(), 3), (20, vector(), 0), (20, vector(), 0), (307, vector(), 9), (310, vector(), 9), (-5, same, 2)]
    schema = "vec_id long, embedding array<float>, label int, block int, top long, part string"
    frame = lambda r: spark.createDataFrame([(*x, 1, 2, "p") for x in r], schema)
    got = hard_negatives(frame(rows), 5).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(map(tuple, got.collect())) == negatives_by_loops(rows, 5)
    vast = [(i, [x * 1e6 for x in v], label) for i, v, label in rows[:60]]
    assert sorted(map(tuple, hard_negatives(frame(vast), 5).select(got.columns).collect())) == negatives_by_loops(vast, 5)
    assert hard_negatives(frame([])).count() == 0


def test_index_leaves_out_tails_and_loses_nothing():
    draw = np.random.default_rng(1)
    x, a = (draw.integers(-90, 90, (n, 64)) for n in (500, 20))
    x[:, 30:] //= 8
    for share in (0.0, 0.2, 0.4):
        t = np.floor(share * np.linalg.norm(a, axis=1) * np.median(np.linalg.norm(x, axis=1)))
        at, row, score = negatives.joined(a, t, x)
        want = x @ a.T
        assert sorted(zip(at, row, score, strict=True)) == sorted((j, i, want[i, j]) for i, j in zip(*np.nonzero(want >= t[None, :]), strict=True))
    assert (negatives.Index(x, 250.0).length < 64).mean() > 0.5


def ranked_by_loops(docs, items, limit):
    known = [(i, terms(t)) for i, t in docs]
    known = [(i, t) for i, t in known if t]
    n, total = len(known), sum(len(t) for _, t in known)
    df = {}
    for _, t in known:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in sorted({(i, t) for i, t in items if t is not None}, key=str):
        scores = []
        for i, t in known:
            m = 50 + (50 * len(t) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 20 * m)) for x in set(terms(text)) if x in t)
            scores.append((-s, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:limit])]
    return sorted(out, key=str)


def sample(seed=5):
    draw = random.Random(seed)
    words = [*"abcdefgh", "Ünï", "x1", "DON", "中文", "rare"]
    text = lambda n: draw.choice([" ", "\n", ", "]).join(draw.choices(words, weights=[9, 7, 5, 4, 3, 2, 2, 1, 1, 1, 1, 1, 0.2], k=n))
    docs = [(i, text(draw.randint(1, 40))) for i in range(200)]
    docs += [(200 + i, docs[i % 7][1]) for i in range(60)] + [(500, None), (501, ""), (502, " ,."), (None, "a rare b"), (3, docs[3][1]), (3, "rare rare"), (503, "a " * 60_000 + "rare")]
    return docs, [(1, "a rare B"), (1, "h x1"), (1, "h x1"), (2, "don't 中文 ünï"), (3, None), (4, ""), (5, "zzz"), (None, "a b c d e f g"), (6, text(30))]


def test_ranked_against_loops(spark, monkeypatch):
    docs, items = sample()
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, term string")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    for limit in (7, 50):
        assert sorted(map(tuple, lexical_search(frame, asked, limit).collect()), key=str) == ranked_by_loops(docs, items, limit)
    whole = sorted(map(tuple, lexical_search(frame, asked, 7).collect()), key=str)
    monkeypatch.setattr(ranked, "ITEM_BYTES", 40)  # several rounds
    assert sorted(map(tuple, lexical_search(frame, asked, 7).collect()), key=str) == whole
    assert lexical_search(frame.limit(0), asked).count() == lexical_search(frame, asked.limit(0)).count() == 0


def test_ranked_over_small_blocks(monkeypatch):
    """Bounds carry over between blocks; steps of one interval, and of many."""
    docs, items = sample(6)
    for block, step in ((7, 1), (64, 3), (4096, 500)):
        monkeypatch.setattr(ranked, "BLOCK", block)
        monkeypatch.setattr(ranked, "STEP", step)
        texts = [t for _, t in items if t]
        own = ranked.distinct_terms([t.encode() for t in texts])
        known = np.unique(np.concatenate(own))
        pieces = [pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs[k : k + block]], "text": [t for _, t in docs[k : k + block]]}, pa.schema([("doc_id", pa.int64()), ("text", pa.string())])) for k in range(0, len(docs), block)]
        posted = list(ranked.postings(iter(pieces), known))
        df = np.zeros(len(known), np.int64)
        for b in posted:
            df += np.bincount(b.column(2).flatten().to_numpy(), minlength=len(known))
        n, total = sum(b.num_rows for b in posted), sum(sum(b.column(1).to_pylist()) for b in posted)
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()])
        found = pa.Table.from_batches(ranked.search_blocks(iter(posted), [np.searchsorted(known, x) for x in own], weight, n, total, 7))
        for k, text in enumerate(texts):
            want = [(s, i) for _, _, i, s in sorted(ranked_by_loops(docs, [(0, text)], 7), key=lambda r: r[1])]
            assert [(s, i) for j, i, s in zip(*[found[c].to_pylist() for c in ("item", "doc_id", "score")], strict=True) if j == k] == want


def best_segments(s, low, high):
    """The segment of greatest sum (the shortest, then first), and those of what is left on its sides."""
    found = max(((round(sum(s[i:j]), 9), i - j, -i, i, j) for i in range(low, high) for j in range(i + 1, high + 1)), default=(0,))
    return [] if found[0] <= 0 else [*best_segments(s, low, found[3]), (found[3], found[4]), *best_segments(s, found[4], high)]


def test_segments_against_search():
    draw = random.Random(4)
    for _ in range(150):
        s = [draw.choice([-3.0, -1.5, -0.5, 0.75, 1.0, 2.25, 4.0]) + draw.random() / 100 for _ in range(draw.randint(0, 18))]
        got = segments(np.array(s))
        assert [(a, b) for a, b, _ in got] == best_segments(s, 0, len(s))
        assert all(abs(v - sum(s[a:b])) < 1e-9 for a, b, v in got)


def test_toxic_words_and_odd_rows(spark):
    """Held-out documents of made words; nulls, empty and long texts, repeated and contrary labels, extra columns, no labels."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("aeiourstln", k=draw.randint(2, 6)))
    plain = [word() for _ in range(300)]
    rows, marks = [], []
    for i in range(900):
        w = draw.choices(plain, k=draw.randint(5, 200))
        if i % 6 == 0:
            at = draw.randrange(len(w))
            w[at:at] = ["Grumpf!", "zonk" + word(), "grumpf"]
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 6 == 0)))
    rows += [(901, None), (902, ""), (903, "..."), (None, "grumpf"), (904, " ".join(draw.choices(plain, k=100_000))), (6, rows[6][1])]
    marks += [(901, 0), (902, 0), (None, 1), (905, 1), (7, None), (7, 0), (6, 1)]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, toxic int")
    labels = spark.createDataFrame([(i, k, "x") for i, k in marks], "doc_id long, toxic int, text string")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    fair = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == int(r.doc_id % 6 == 0) for r in fair) >= 0.97 * len(fair)
    assert all(r.predicted == 0 for r in got if r.doc_id in (901, 902, 903, 904))
    assert all(len(r.passages) == 1 and r.passages[0].n_words <= 4 for r in fair if r.predicted and r.doc_id % 6 == 0 and r.n_tokens > 20)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {(r.score, r.predicted) for r in toxicity(docs, none).collect()} == {(0.0, 0)}
    assert toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_of_tables(spark):
    """Held-out labels of the given tables."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.975 * len(rows)
    assert sum(r.predicted for r in rows if r.toxic) >= 0.9 * sum(r.toxic for r in rows)


def test_trained_attention_beats_the_class_table(spark, monkeypatch):
    """Held-out log probability with trained weights against that of the corpus's class pairs alone."""
    import public_tokenizers
    from pyspark.sql import functions as F

    from gridwatch.llm import scoring

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = lambda: scoring.lm_scores(docs, public_tokenizers.path("byte_bpe_50k.json")).filter("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    trained, base = held()
    monkeypatch.setattr(scoring, "ROUNDS", 0)
    table, _ = held()
    assert trained > table + 0.05 > base + 0.05
