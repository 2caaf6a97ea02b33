"""Vector codes, importance draw and scaled sketches against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tarmac.llm import importance, sketch, vector_codes

# ── vector codes ──────────────────────────────────────────────────────

VECTORS = "vec_id long, embedding array<double>, label int, ints string, codes string, error string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", "y", "z") for i, v, l in rows], VECTORS)


def plain_codes(rows, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    w = -(-dim // 4)
    cut = [[(v + [0] * (4 * w - dim))[k * w: k * w + w] for k in range(4)] for _, v, _ in kept]
    books = [[list(c[k]) for c in cut[:entries]] for k in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(book))
    for _ in range(rounds):
        for k in range(4):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[k], books[k])[1], []).append(c[k])
            for j, xs in members.items():
                books[k][j] = [sum(col) // len(xs) for col in zip(*xs)]
    out = []
    for (i, _, l), c in zip(kept, cut):
        found = [nearest(c[k], books[k]) for k in range(4)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(e for e, _ in found), l))
    sums = {}
    for _, _, e, l in out:
        sums[l] = sums.get(l, 0) + e
    text = ",".join(str(v) for b in books for c in b for v in c)
    return ([(i, code, e, sums[l]) for i, code, e, l in out], hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("n, dim, spread", [(700, 8, 0.2), (900, 8, 0.004), (60, 6, 1.0), (400, 4, 30000.0)])
def test_codes_equal_plain_search(spark, n, dim, spread):
    rng = random.Random(n)
    rows = [(k * 3, [rng.gauss(0, spread) for _ in range(dim)], rng.choice((1, 2, None))) for k in range(n)]
    rows += [(5, rows[0][1], 1)] * 40 + [(7, [0.0] * dim, 2)] * 30          # one very common vector
    rows += [(None, [0.25] * dim, 1), (8, None, 1), (10, [], 1), (11, [float("nan")] * dim, 1),
             (13, [None] + [0.0] * (dim - 1), 1), (14, [float("inf")] * dim, 2), (16, [1.0] * (dim + 1), 2)]
    rng.shuffle(rows)
    got = vector_codes.code_report(frame(spark, rows).repartition(5)).collect()
    want, sha = plain_codes(rows)
    key = lambda r: (r[0] is None, r)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=key) == sorted(want, key=key)
    assert {r.codebooks_sha256 for r in got} == {sha}


def test_codes_without_vectors(spark):
    assert vector_codes.code_report(frame(spark, [])).collect() == []
    assert vector_codes.code_report(frame(spark, [(1, None, 1), (2, [float("nan")], 1)])).collect() == []


def test_codes_of_enormous_components_are_held(spark):
    rows = [(1, [3e38, 0.0, 0.0, -3e38], 1), (2, [1.0, 2.0, 3.0, 4.0], 1)]
    got = {r.vec_id: r for r in vector_codes.code_report(frame(spark, rows)).collect()}
    assert got[1].error == got[2].error == 0 and got[1].code != got[2].code


@pytest.mark.parametrize("seed", range(6))
def test_balls_equal_full_search(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-40, 40, (32, 3))
    entries[5] = entries[20]                                    # two entries at one place
    x = rng.integers(-40, 40, (3000, 3))
    x[:200] = entries[20]
    x[200:400] = (entries[3] + entries[9]) // 2                 # near ties
    before = rng.integers(0, 32, len(x))
    gaps = vector_codes.squares(entries, entries)
    a, b = vector_codes.nearest_by_balls(x, entries, gaps, before), vector_codes.nearest_of_all(x, entries)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    big = vector_codes.squares(x * (1 << 20), entries * (1 << 20))
    assert (big == vector_codes.squares(x, entries) << 40).all()


# ── importance draw ───────────────────────────────────────────────────

DOCS = "doc_id long, text string, score double, weight int, rank string, row int, n_features string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, 1.0, 1, "r", 1, "n") for i, t in rows], DOCS)


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 128:
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_draw(docs, target, longest=1, percent=10):
    def buckets(text):
        ws = plain_words(text)
        return [zlib.crc32(" ".join(ws[i: i + k]).encode()) % 10000
                for k in range(1, longest + 1) for i in range(len(ws) - k + 1)]
    s, t = [0] * 10000, [0] * 10000
    for _, text in docs:
        for b in buckets(text):
            s[b] += 1
    for text in target:
        for b in buckets(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000))))
            for b in range(10000)]
    rows = []
    for i, text in docs:
        f = buckets(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, len(plain_words(text))])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.fixture(scope="module")
def draw_docs():
    rng = random.Random(5)
    stock = [" ".join(["Ärger", "naïve", "x1", "THE", "the", "été-là", "日本", "a_b"][rng.randrange(8)] for _ in range(4))
             for _ in range(50)] + ["b" * 300, "q" * 129 + "ß"]
    docs = [(k, ", ".join(rng.choice(stock) for _ in range(rng.randint(1, 30)))) for k in range(400)]
    docs += [(k, "one") for k in range(400, 420)] + [(9000, None), (9001, ""), (9002, " .,-"), (None, "the " * 30)]
    target = ["the naïve x1", "Ärger b", None, ""]
    return docs, target


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 35), (3, 100)])
def test_draw_equals_plain_version(spark, draw_docs, longest, percent):
    docs, target = draw_docs
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs_frame(spark, docs).repartition(7), goal, percent, longest=longest)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_draw(docs, target, longest, percent)


def test_draw_cuts_through_ties(spark, monkeypatch):
    """All rows have one score: the cut falls among doc_ids, then among rows of one doc_id."""
    monkeypatch.setattr(importance, "gumbel", lambda doc_id, seed: F.lit(0).cast("long"))
    text = "word " * 25
    docs = [(k, text) for k in range(95)] + [(3, text)] * 105
    goal = spark.createDataFrame([("word",)], "text string")
    got = importance.resample(docs_frame(spark, docs).repartition(6), goal).collect()
    ranks = sorted((r["rank"], r.doc_id) for r in got if r["rank"])
    assert [k for k, _ in ranks] == list(range(1, 21))
    assert [i for _, i in ranks] == [0, 1, 2] + [3] * 17


def test_draw_of_nothing(spark):
    goal = spark.createDataFrame([], "text string")
    assert importance.resample(docs_frame(spark, []), goal).collect() == []
    few = importance.resample(docs_frame(spark, [(1, "w " * 30), (2, None)]), goal).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in few) == [(1, 30, None), (2, 0, None)]


# ── scaled sketches ───────────────────────────────────────────────────


def plain_sketch(text, scale=sketch.SCALE):
    folded = "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\x0b\f\r" else c for c in text or "")
    ws = [w for w in folded.split(" ") if w]
    kept = set()
    for i in range(len(ws)):
        h = 42
        for w in ([""] * 4 + ws)[i: i + 5]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        if h < (1 << 64) // scale:
            kept.add(h)
    whole = hashlib.md5(" ".join(ws).encode()).hexdigest()
    return len(ws), whole, sorted(kept)


def plain_print(s):
    return f"{s[0]}:{s[1]}:{','.join(format(h, 'X') for h in s[2])}"


def plain_likeness(a, b):
    if a[1] == b[1]:
        return 1.0
    a, b = set(a[2]), set(b[2])
    return len(a & b) / len(a | b) if a | b else 0.0


def sketch_docs():
    rng = random.Random(9)
    stock = ["Über", "the", "THE", "fox", "日本", "jumps", "é", "1", " x", "-", "end."]
    texts = [" ".join(rng.choice(stock) for _ in range(rng.choice((0, 1, 2, 4, 9, 60, 400)))) for _ in range(120)]
    texts += [None, "", "\n", "a", texts[5], texts[5], "🙂🙃" * 7, "w" * 5000, "the fox " * 2000]
    ids = rng.sample(range(-500, 10**6), len(texts))
    return list(zip(ids, texts))


def plain_report(docs):
    rows = sorted(((i, t or "") for i, t in docs), key=lambda r: (r[0] is None, r[0] or 0, _hash(r[1])))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain_print(a), plain_print(b),
                    plain_likeness(a, b), plain_likeness(a, c)))
    return sorted(out, key=str)


def _hash(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


@pytest.mark.parametrize("parts", [1, 6])
def test_edited_report_equals_plain_version(spark, parts):
    docs = sketch_docs() + [(77, "same id one"), (77, "same id two"), (None, "no id"), (None, None)]
    got = sketch.edited_report(docs_frame(spark, docs).repartition(parts))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert sorted((tuple(r)[:7] for r in got.collect()), key=str) == plain_report(docs)


def test_edited_report_of_few_rows(spark):
    assert sketch.edited_report(docs_frame(spark, [])).collect() == []
    one = sketch.edited_report(docs_frame(spark, [(4, "a b c d")])).collect()
    assert [tuple(r)[:7] for r in one] == plain_report([(4, "a b c d")])
    same = sketch.edited_report(docs_frame(spark, [(4, "a b"), (4, "a b"), (4, "a b")])).collect()
    assert [(r.near_next, r.edited_fingerprint) for r in same] == [(1.0, plain_print(plain_sketch("a a")))] * 3 or \
        sorted(tuple(r)[:7] for r in same) == plain_report([(4, "a b")] * 3)


def test_merged_sketches_estimate_containment(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40000)]
    long = " ".join(rng.choice(words) for _ in range(20000))
    inside = " ".join(long.split(" ")[5000:5600])
    mixed = inside + " " + " ".join(rng.choice(words) for _ in range(600))
    rows = [("src", 1, inside), ("src", 2, mixed), ("src", 3, " ".join(rng.choice(words) for _ in range(500))),
            ("src", 4, None)]
    parts = [("src", long[:60000]), ("src", long[59950:]), ("other", inside)]
    sk = lambda r: spark.createDataFrame(r[0], r[1]).withColumn("sketch", sketch.sketch(F.col("text")))
    union = sketch.merged(sk((parts, "key string, text string")), "key")
    assert union.groupBy("key", "hash").count().where("count > 1").count() == 0
    got = {r.id: r.contained for r in sketch.containment_in(
        sk((rows, "key string, id long, text string")), union, "key", "id").collect()}
    assert got[1] > 0.95 and 0.4 < got[2] < 0.6 and got[3] < 0.02 and 4 not in got
    a, b = (spark.createDataFrame([(t,)], "text string").select(sketch.sketch(F.col("text")).alias("s")) for t in (mixed, long))
    both = a.crossJoin(b.withColumnRenamed("s", "t"))
    there, back = both.select(sketch.containment(F.col("s"), F.col("t")), sketch.containment(F.col("t"), F.col("s"))).first()
    assert abs(there - got[2]) < 0.02 and back < 0.1
