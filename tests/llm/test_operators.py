"""Corpus operators on small tables: defined cases, and plain versions of the same."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import class_evidence, cut_repeats, find_components, jaccard_report
from tarmac.llm import (chat_format, common, decontaminate, ego_join, kneser_ney, license_scan, line_crf,
                        ngram_jaccard, piece_viterbi, suffix_dedup, warc)

DOCS = "doc_id long, text string, n int, score double, tid long, cls long"


def docs_frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1, 0.0, 1, 1) for i, t in rows], DOCS)


def prose(rng, n, stock="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(stock) for _ in range(rng.randint(2, 6))) for _ in range(n))


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(int(share * len(words))):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


@pytest.fixture(scope="module")
def family_docs():
    """Copies, near copies at many distances, short and empty texts, a shared passage."""
    rng = random.Random(11)
    texts = [None, "", " \n", "one", "One", "one two three", "a b c d e", "A b c d e"]
    shared = prose(rng, 60)
    for _ in range(6):
        stem = prose(rng, 150)
        texts += [stem, stem, stem.upper()] + [edited(rng, stem, rng.choice((0.01, 0.02, 0.04, 0.06, 0.1)))
                                               for _ in range(14)]
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, 30) for _ in range(12)]
    texts += [prose(rng, 2500)] * 2
    return dict(enumerate(texts, 100))


def test_jaccard_components_equal_brute_force(spark, family_docs):
    rows = [*family_docs.items(), (None, "one"), (None, None)]
    got = ngram_jaccard.link_components(docs_frame(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == jaccard_report(family_docs)
    assert sorted((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == [(0, None), (1, None)]


def test_jaccard_keeps_one_of_each_group_and_all_columns(spark, family_docs):
    rows = [*family_docs.items(), (None, "one"), (103, "one")]
    df = docs_frame(spark, rows)
    got = ngram_jaccard.one_of_each(df)
    assert got.columns == df.columns
    want = {i for i, (_, c) in jaccard_report(family_docs).items() if i == c}
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_jaccard_keeps_unlinked_texts_of_one_id(spark):
    rng = random.Random(23)
    one, two, three = (prose(rng, 60) for _ in range(3))
    rows = [(1, one), (1, two), (1, one.upper()), (2, two), (3, three), (3, one), (4, None), (4, ""), (4, " "), (4, "")]
    df = docs_frame(spark, rows)
    want = [(1, one), (1, two), (3, three), (4, ""), (4, " "), (4, None)]
    got = [[(r.doc_id, r.text and r.text.lower()) for r in ngram_jaccard.one_of_each(df.repartition(k)).collect()]
           for k in (1, 4)]
    assert [sorted(g, key=str) for g in got] == [sorted(want, key=str)] * 2


def test_jaccard_without_documents(spark):
    empty = docs_frame(spark, [])
    assert ngram_jaccard.link_components(empty).collect() == []
    assert ngram_jaccard.one_of_each(empty).collect() == []


def test_repeats_equal_brute_force(spark):
    rng = random.Random(12)
    passage = prose(rng, 130)
    stem = prose(rng, 300)
    texts = [None, "", "w" * 399, "w" * 399, "v" * 400, "v" * 400, "é" * 300, "ab" * 700, "x" * 401, "x" * 900,
             prose(rng, 50) + passage + prose(rng, 90), passage, "é" + passage + "ü" * 7, passage[:401], passage[100:499],
             passage + passage, stem, stem, *(edited(rng, stem, 0.01) for _ in range(6))]
    docs = dict(enumerate(texts))
    want = cut_repeats(docs)
    df = docs_frame(spark, list(docs.items()) + [(None, "v" * 400)]).repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(df).collect()}
    assert got.pop(None)[:2] == (400, 400)
    assert got == {i: w[:4] for i, w in want.items()}
    kept = suffix_dedup.without_repeats(df)
    assert kept.columns == df.columns
    assert {r.doc_id: r.text for r in kept.collect() if r.doc_id is not None} == {
        i: None if docs[i] is None else w[4].decode("utf-8", "ignore") for i, w in want.items()}


def beginning_without_contexts(rng):
    """Two texts with one beginning of which every anchor's context is shared, up to its very end."""
    codes = common.byte_codes(fold_case=False)
    while True:
        stem = prose(rng, 400)
        buf = np.frombuffer(stem.encode(), np.uint8)
        starts = suffix_dedup.chunk_anchors(buf, np.array([0, len(buf)]), codes)[3]
        for at in starts.tolist():
            shared, docs = stem[: at + 400], []
            for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
                text = shared + c + prose(rng, 150)
                raw = np.frombuffer(text.encode(), np.uint8)
                found = suffix_dedup.chunk_anchors(raw, np.array([0, len(raw)]), codes)[3]
                if found[found <= at + 200].max() == at:
                    docs.append(text)
            if docs:
                return len(shared), docs[0], shared + "~" + prose(rng, 150)


def test_rest_behind_a_shared_beginning_stays(spark):
    size, one, other = beginning_without_contexts(random.Random(21))
    docs = {1: one, 2: other, 3: one[:size][::-1] + "x", 4: "y" + one[:size][::-1]}
    want = cut_repeats(docs)
    assert want[1][:3] == (len(one), size, 1) and want[2][:3] == (len(other), size, 1)
    df = docs_frame(spark, list(docs.items()))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(df).collect()}
    assert got == {i: w[:4] for i, w in want.items()}
    assert {r.doc_id: r.text for r in suffix_dedup.without_repeats(df).collect()} == {
        i: w[4].decode() for i, w in want.items()}


def test_repeats_without_documents(spark):
    assert suffix_dedup.removal_report(docs_frame(spark, [])).collect() == []


def test_text_ids_are_those_of_spark(spark):
    texts = ["", "a", "é" * 50, "x" * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t"), "t")
    assert {r.t: r[0] for r in df.collect()} == {t: suffix_dedup.text_id(t.encode()) for t in texts}


def test_decontamination_report_and_filter(spark, monkeypatch):
    rng = random.Random(13)
    items = [(i, prose(rng, 40)) for i in range(6)] + [(6, "short item"), (7, None), (8, ""), (9, prose(rng, 40))]
    near = edited(rng, items[1][1], 0.05)
    rows = [(0, None), (1, ""), (2, prose(rng, 80)), (3, prose(rng, 30) + " " + items[0][1] + "\n" + prose(rng, 9)),
            (4, near.upper()), (5, items[2][1][: 120]), (6, "short item " + prose(rng, 20)),
            (None, items[3][1]), (7, items[0][1] + " " + items[9][1])]
    df = docs_frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in decontaminate.report(df, bench).collect()}
    clean = (False, 0, [])
    assert got == {0: clean, 1: clean, 2: clean, 6: (True, 1, [6]), 3: (True, 1, [0]), 4: (True, 1, [1]),
                   5: (True, 1, [2]), None: (True, 1, [3]), 7: (True, 2, [0, 9])}
    kept = decontaminate.clean_documents(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {0, 1, 2}
    monkeypatch.setattr(decontaminate, "PART_CODES", 300)           # the benchmark in several parts
    again = {r.doc_id: (r.contaminated, r.n_items, r.item_ids) for r in decontaminate.report(df, bench).collect()}
    assert again == got


def test_short_items_are_found(spark):
    rng = random.Random(17)
    items = [(n, prose(rng, 12)[:n].strip("\x20").ljust(n, "x")) for n in range(8, 40)]
    items += [(100, "Yes"), (101, "4²"), (102, "What is the capital of France?"), (103, "été")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def around(text):
        return "0000 1111 2222 3333 " + text + " 4444 5555 6666 7777"
    rows = [(n, around(t.upper())) for n, t in items if n < 100]
    # one changed code point: within the budget from 16 code points on
    rows += [(1000 + n, around(t[:3] + "#" + t[4:])) for n, t in items if n < 100]
    rows += [(200, "yes"), (201, "(YES)"), (202, "yesterday, eyes"), (203, "x4²"), (204, "is 4²."), (205, "étés"),
             (206, "l'été"), (207, around("What is the  capital of\nFrance?"))]
    got = {r.doc_id: r.item_ids for r in decontaminate.report(docs_frame(spark, rows), bench).collect()}
    want = {n: [n] for n, _ in items if n < 100}
    want |= {1000 + n: [n] if n >= 16 else [] for n, _ in items if n < 100}
    want |= {200: [100], 201: [100], 202: [], 203: [], 204: [101], 205: [], 206: [103], 207: [102]}
    assert got == want


@pytest.mark.parametrize("names", [["_tid", "_text", "_leaky"], ["tid", "row", "kept_text"], ["id", "n_bytes", "shared"]])
def test_filtering_stages_keep_further_columns(spark, names):
    rng = random.Random(19)
    passage, item = prose(rng, 120), prose(rng, 40)
    texts = [prose(rng, 30) + " " + passage, passage + " " + prose(rng, 30), item, None, prose(rng, 9)]
    df = spark.createDataFrame([(i, t, 5 + i, "mine", 0.5) for i, t in enumerate(texts)],
                               f"doc_id long, text string, {names[0]} int, {names[1]} string, {names[2]} double")
    cut = suffix_dedup.without_repeats(df)
    assert cut.columns == df.columns
    assert {tuple(r)[0]: tuple(r)[2:] for r in cut.collect()} == {i: (5 + i, "mine", 0.5) for i in range(5)}
    clean = decontaminate.clean_documents(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert clean.columns == df.columns and sorted(tuple(r)[:1] + tuple(r)[2:] for r in clean.collect()) == [
        (i, 5 + i, "mine", 0.5) for i in (0, 1, 3, 4)]


@pytest.mark.parametrize("window", [101, 240])
def test_shorter_windows_equal_brute_force(spark, window):
    rng = random.Random(window)
    texts = [prose(rng, rng.randint(1, 120)) for _ in range(20)]
    for words in (51, 55, 60):                                   # passages of 51 to 60 words
        passage = prose(rng, words)
        texts += [prose(rng, 30) + " " + passage + " " + prose(rng, 20) for _ in range(3)]
    texts += [texts[0] * 4, "ab" * 300, "é" * 200, None, texts[3], texts[3]]
    docs = dict(enumerate(texts))
    want = cut_repeats(docs, window)
    df = docs_frame(spark, docs.items()).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(df, window).collect()}
    assert got == {i: w[:4] for i, w in want.items()}
    both = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(df, passage=window).collect()}
    assert both == {i: (*w[:4], want[i][1]) for i, w in cut_repeats(docs).items()}


def test_texts_that_share_a_hash_stay_apart(spark, monkeypatch):
    rng = random.Random(29)
    passage = prose(rng, 130)
    texts = [prose(rng, 150) for _ in range(6)] + [prose(rng, 40) + " " + passage for _ in range(3)]
    docs = dict(enumerate(texts + texts[:2] + ["", None, "short"]))
    monkeypatch.setattr(suffix_dedup, "first_hash", lambda text: F.lit(7).cast("long"))
    want = cut_repeats(docs)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_report(docs_frame(spark, docs.items())).collect()}
    assert got == {i: w[:4] for i, w in want.items()}


@pytest.mark.parametrize("few", [10_000, 20])
def test_long_intervals_meet_once_in_the_leading_cells(spark, monkeypatch, few):
    import numpy as np
    monkeypatch.setattr(ego_join, "FEW", few)
    rng = np.random.default_rng(41)
    rows, boxes = [], {}
    for k in range(150):
        label = k % 3 if k < 30 else 0                      # a hot label, two with few intervals
        lo = rng.uniform(-1, 1, ego_join.DIMENSIONS) * rng.choice((0.3, 1))
        hi = np.minimum(lo + rng.choice((0.0, 0.05, 0.9), ego_join.DIMENSIONS), 1)
        if k % 10 == 0:                                     # borders of cells
            lo = np.round(lo / ego_join.EPSILON) * ego_join.EPSILON
            hi = np.maximum(hi, lo)
        boxes[k] = (label, lo, hi)
        rows.append((k, k, label, 12, lo.tolist(), hi.tolist()))
    box = spark.createDataFrame(rows, "block long, long long, label long, dim int, lo array<double>, hi array<double>")
    got = sorted((r.long_a, r.long_b) for r in ego_join.long_pairs(box.repartition(4)).collect())
    want = []
    for a, (la, lo, hi) in boxes.items():
        for b, (lb, lo_b, hi_b) in boxes.items():
            gap = np.maximum(0, np.maximum(lo_b - hi, lo - hi_b))
            if a <= b and la == lb and (gap * gap).sum() <= ego_join.NEAR:
                want.append((a, b))
    assert got == want and len(want) > 200


def test_decontamination_without_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(docs_frame(spark, []), none).collect() == []
    assert decontaminate.clean_documents(docs_frame(spark, [(1, "a")]), none).count() == 1


@pytest.mark.parametrize("few", [64, 0])
def test_vector_links_equal_brute_force(spark, monkeypatch, few):
    import numpy as np
    monkeypatch.setattr(ego_join, "BLOCK", 16)
    monkeypatch.setattr(ego_join, "SPREAD", 2)
    monkeypatch.setattr(ego_join, "FEW", few)               # 0: every label meets in cells
    rng = np.random.default_rng(14)
    rows = []
    for label in (0, 1):
        c = rng.normal(size=(8, 12))
        for k in range(120):
            v = c[rng.integers(0, 8)] + rng.choice((0.02, 0.1, 0.2)) * rng.normal(size=12)
            rows.append((label * 1000 + k, [float(x) for x in np.float32(v)], label))
    rows += [(5000 + k, rows[3][1], rows[3][2]) for k in range(30)]          # copies
    rows += [(6000, [2 * x for x in rows[3][1]], rows[3][2])]
    odd = [(7000, None, 0), (7001, [0.0] * 12, 0), (7002, [None] + [1.0] * 11, 0), (7003, [float("inf")] * 12, 0),
           (7004, rows[3][1], None), (7005, [], 0), (7006, [1.0] * 5, 0), (None, rows[3][1], 0)]
    df = spark.createDataFrame([(i, v, x, 1) for i, v, x in rows + odd],
                               "vec_id long, embedding array<float>, label int, cls int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ego_join.link_report(df.repartition(6)).collect()}
    want = {r[0]: (0, r[0], True) for r in odd}
    for label in (0, 1):
        part = [r for r in rows if r[2] == label]
        x = np.array([r[1] for r in part])
        x /= np.linalg.norm(x, axis=1)[:, None]
        link = x @ x.T >= 0.98
        np.fill_diagonal(link, False)
        ids = [r[0] for r in part]
        comp = find_components(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(link))])
        want |= {i: (int(link[k].sum()), comp[i], comp[i] == i) for k, i in enumerate(ids)}
    assert got == want
    assert ego_join.link_report(df.limit(0)).collect() == []


def line_corpus(rng, n):
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        lines = [prose(rng, 12).capitalize() + "." for _ in range(rng.randint(1, 8))]
        if bad:
            lines[rng.randrange(len(lines))] = " ".join(w + "$$$" for w in prose(rng, 10).split())
        docs.append((i, "\n".join(lines)))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_line_model_ranks_held_out_documents(spark):
    docs, labels = line_corpus(random.Random(15), 400)
    odd = [(1000, None), (1001, ""), (1002, "\n\n"), (None, "x"), (1003, "word " * 20000)]
    df = docs_frame(spark, docs + odd)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (5000, None, 0), (0, labels[0][1], 0)],
                                  "doc_id long, quality int, toxic int")
    got = line_crf.quality(df, marks).collect()
    assert len(got) == len(docs) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert by[None].held_out is False
    for i, q, _ in labels:
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(by[i].score, q, by[i].predicted) for i, q, _ in labels if by[i].held_out]
    assert sum(p == q for _, q, p in held) / len(held) > 0.95
    kept = line_crf.good_documents(df, marks)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(r.doc_id) for r in got if r.predicted)


def test_line_model_reads_no_held_out_label(spark):
    docs, labels = line_corpus(random.Random(16), 120)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    schema = "doc_id long, quality int, toxic int"
    a, b = (sorted(line_crf.quality(docs_frame(spark, docs), spark.createDataFrame(x, schema)).collect())
            for x in (labels, turned))
    assert a == b


def test_models_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs_frame(spark, [(1, "a b"), (2, None)])
    assert [(r.score, r.predicted) for r in line_crf.quality(df, none).collect()] == [(0.5, 0)] * 2
    assert line_crf.good_documents(df, none).count() == 2
    assert [(r.score, r.predicted) for r in kneser_ney.toxicity(df, none).collect()] == [(0.0, 0)] * 2
    assert line_crf.quality(docs_frame(spark, []), none).collect() == []
    assert kneser_ney.toxicity(docs_frame(spark, []), none).collect() == []


def test_toxicity_finds_stems_with_unseen_endings(spark):
    rng = random.Random(17)
    docs, labels = [], []
    for i in range(500):
        toxic = rng.random() < 0.3
        words = prose(rng, 60).split(" ")
        for _ in range(3 * toxic):
            words[rng.randrange(60)] = rng.choice(("zyxw", "qqut")) + prose(rng, 1)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    odd = [(1000, None), (1001, ""), (1002, "123 !?"), (None, "x")]
    df = docs_frame(spark, docs + odd)
    got = {r.doc_id: r for r in kneser_ney.toxicity(
        df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 504 and all(0 <= r.score <= 1 for r in got.values())
    held = [(got[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == t for r, t in held) / len(held) > 0.95


def test_toxicity_is_the_same_beyond_the_broadcast(spark, monkeypatch):
    rng = random.Random(22)
    docs, labels = [(900, None), (901, ""), (902, "123 !?"), (None, "x"), (903, "zyxwab " * 5)], [(0, 1, 1), (1, 1, 0)]
    for i in range(300):
        found = rng.random() < 0.4
        docs.append((i, " ".join([prose(rng, 30)] + found * [rng.choice(("zyxw", "qqut")) + prose(rng, 1)])))
        labels.append((i, 1, int(found)))
    docs += docs[-9:]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")

    def scores():
        rows = kneser_ney.toxicity(docs_frame(spark, docs).repartition(3), marks).collect()
        return sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.predicted, r.score) for r in rows)

    want = scores()
    monkeypatch.setattr(kneser_ney, "MAX_GRAMS", 500)
    monkeypatch.setattr(kneser_ney, "KNOWN_WORDS", 200)
    got = scores()
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-9)


@pytest.mark.parametrize("order, shared", [(3, 3), (kneser_ney.ORDER, kneser_ney.SHARED)])
def test_evidence_equals_plain_kneser_ney(spark, monkeypatch, order, shared):
    monkeypatch.setattr(kneser_ney, "ORDER", order)
    monkeypatch.setattr(kneser_ney, "SHARED", shared)
    rng = random.Random(31)
    docs = [("abra cadabra abba abra", 1), ("brab arc abra", 0), ("dab", None), ("", 1), ("achlicher achlichtz", 1),
            ("wachlich lich", 0)]
    docs += [(" ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(6)), k % 3 - 1)
             for k in range(9)]
    docs = [(t, None if c == -1 else c) for t, c in docs]
    model = kneser_ney.fit_counts(spark.createDataFrame(docs, "text string, label int").repartition(3))
    sign = {kneser_ney.START: "^", kneser_ney.END: "$"}

    def spelled(g, n):
        x = [g >> (kneser_ney.BITS * k) & 63 for k in range(n)][::-1]
        return "".join(sign.get(c) or chr(96 + c) for c in x)

    grams, contexts = class_evidence(docs, order, shared)
    got = {spelled(int(g), order): e for g, e in zip(model.grams, model.evidence)}
    assert got == pytest.approx(grams, abs=1e-12)
    got = {spelled(int(h), order - 1): e for h, e in zip(model.contexts, model.context_evidence)}
    assert got == pytest.approx(contexts, abs=1e-12)


def test_toxicity_tells_stems_from_the_same_letters_inside_words(spark):
    rng = random.Random(37)
    pieces = ("ach", "lich", "keit", "ung", "ein", "sch")
    docs, labels = [], []
    for i in range(600):
        toxic = rng.random() < 0.3
        words = ["".join(rng.choice(pieces) for _ in range(rng.randrange(2, 4))) for _ in range(40)]
        words = ["x" + w if w.startswith("achlich") else w for w in words]       # never at the beginning
        for _ in range(3 * toxic):
            words[rng.randrange(40)] = "achlich" + rng.choice(pieces)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(any(w.startswith("achlich") for w in words))))
    got = {r.doc_id: r for r in kneser_ney.toxicity(
        docs_frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [(got[i].predicted, t) for i, _, t in labels if got[i].held_out]
    assert sum(p == t for p, t in held) / len(held) > 0.97


def test_shared_backoff_is_a_distribution(spark):
    docs = spark.createDataFrame([("abra cadabra abba", 1), ("brab arc", 0), ("dab", None)], "text string, label int")
    table = common.stored(kneser_ney.gram_counts(docs, kneser_ney.ORDER), "t")
    p = kneser_ney.shared_backoff(table, 3).collect()
    by = {}
    for r in p:
        by.setdefault(r.s >> kneser_ney.BITS, []).append(r.p)
    assert all(0 < sum(v) <= 1 + 1e-9 for v in by.values())
    counts = {r.g: (r.toxic, r.ordinary) for r in table.collect()}
    sym, _ = kneser_ney.symbols(["abra"])
    g, _ = kneser_ney.grams(sym, kneser_ney.np.array([0]), kneser_ney.np.array([4]), kneser_ney.ORDER)
    assert counts[int(g[0])] == (2, 1)               # words that begin with a: abra and abba; arc


def test_tokens_of_documents(spark):
    rows = [(1, "the thandedble\nerest"), (2, None), (3, ""), (None, "x"), (1, "y"), (4, "日本 \U0001F600 " * 3000)]
    got = piece_viterbi.encoded_and_checked(docs_frame(spark, rows)).collect()
    assert len(got) == 6 and all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    assert {r.doc_id for r in got if not r.ids} == {2, 3}
    df = docs_frame(spark, rows[3:])
    back = piece_viterbi.decoded(piece_viterbi.encoded(df)).collect()
    assert sorted(r.text for r in back) == sorted(t for _, t in rows[3:])
    assert piece_viterbi.encoded_and_checked(docs_frame(spark, [])).collect() == []


def test_a_text_that_does_not_come_back_is_told(spark):
    rows = [(1, "x▁y"), (2, "x y"), (3, "▁"), (4, None)]
    got = piece_viterbi.encoded_and_checked(docs_frame(spark, rows)).collect()
    assert {r.doc_id: r.round_trip for r in got} == {1: False, 2: True, 3: False, 4: True}


def test_captures_round_trip_through_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_FILE", 3)
    big = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\né" + "z" * 1200
    rows = [(1, "http://a/\r\nX: y", big), (2, "u", big), (9, None, big), (3, "u", "small"), (4, "u", "small"),
            (5, "u", None), (6, "u", ""), (7, "u", big + "!"), (8, "u", "ü" * 500), (10, "u", "ü" * 500), (10, "u", "ü" * 500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = {r.page_id: tuple(r)[1:] for r in warc.capture_report(spark, df.repartition(2)).collect()}
    import hashlib
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if h == html and len(raw) >= 1000]
        last = max(same, default=i)
        assert got[i] == (len(raw), hashlib.sha1(raw).hexdigest(), "response" if last == i else "revisit",
                          None if last == i else last)
    assert len(got) == 10
    assert warc.capture_report(spark, df.limit(0)).collect() == []


def test_captures_are_nested_and_keep_orphans(spark):
    fields = spark.createDataFrame([
        ("response", "r1", [], None, "u", "d", "x", 1, bytearray(b"p"), {}),
        ("request", "q1", ["r1"], None, "u", "d", "y", 0, bytearray(b""), {"line": "GET"}),
        ("request", "q2", ["r1"], None, "u", "d", "y", 0, bytearray(b""), {"line": "HEAD"}),
        ("metadata", "m1", ["gone"], None, "u", "d", "z", 0, bytearray(b""), {"a": "b"}),
        ("response", "r2", [], None, "u", "d", "x", 1, bytearray(b"p"), {})], warc.RECORDS_DDL)
    got = {r.capture_id: r for r in warc.captures(fields).collect()}
    assert set(got) == {"r1", "r2", "gone"}
    assert [q.record_id for q in got["r1"].requests] == ["q1", "q2"] and bytes(got["r1"].response.payload) == b"p"
    assert got["gone"].response is None and got["gone"].metadata[0].fields[0].value == "b"
    assert got["r2"].requests is None


def test_licences_of_lines_and_whole_texts(spark):
    mit = license_scan.TEMPLATES[-2][1]
    rows = [(1, "x\nReleased under the MIT license!\ny"), (2, None), (3, ""), (4, "plain words only here"),
            (5, mit.replace(". ", ".\n").replace(", ", ",\n")), (6, "licensed under cc by-nc 4.0\nLicensed under CC BY 4.0"),
            (None, "Released under the MIT License."), (7, "word " * 30000)]
    got = {r.doc_id: r for r in license_scan.scan(docs_frame(spark, rows)).collect()}
    assert got[1].license == "MIT" and got[1].dice == 1.0 and got[1].n_units == 1
    assert got[5].license == "MIT" and got[5].licenses == ["MIT"]
    assert got[6].licenses == ["CC-BY-4.0", "CC-BY-NC-4.0"] and got[6].n_units == 3     # the whole text too
    assert got[None].license == "MIT"
    assert all(got[k].license is None and got[k].n_units == 0 and got[k].licenses == [] for k in (2, 3, 4, 7))
    plan = license_scan.scan(docs_frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_licences_wrapped_and_inside_other_text(spark):
    paragraph, whole = (t for name, t in license_scan.TEMPLATES if name == "MIT" and len(t) > 100)
    rng = random.Random(31)

    def wrapped(text, width=72):
        lines, line = [], ""
        for w in text.split(" "):
            if len(line) + len(w) > width:
                lines.append(line)
                line = ""
            line = (line + " " + w).strip()
        return "\n".join([*lines, line])
    other = prose(rng, 80)
    changed = paragraph.replace("associated documentation files", "the files beside it").replace("merge, ", "")
    rows = [(1, other + "\n" + wrapped(paragraph) + "\n" + other), (2, other + " Released under the MIT License. " + other),
            (3, "MIT License\n\nCopyright (c) 2024 N. N.\n\n" + wrapped(whole)), (4, other + "\n" + wrapped(changed) + "\n" + other),
            (5, "the mit license is one of many that people talk about, " + other), (6, other), (7, None), (8, ""),
            (8, "Released under the MIT License. " * 3), (9, "permission " * 20000)]
    got = sorted(license_scan.scan(docs_frame(spark, rows)).collect(), key=lambda r: (r.doc_id, r.n_windows))
    found = [(r.doc_id, r.license, r.n_windows) for r in got]
    assert [f[:2] for f in found] == [(1, "MIT"), (2, "MIT"), (3, "MIT"), (4, "MIT"), (5, None), (6, None), (7, None),
                                      (8, None), (8, "MIT"), (9, None)]
    assert found[1][2] == 1 and found[8][2] == 3 and got[0].dice == 1.0 and got[2].dice == 1.0 and got[3].dice >= 0.8
    assert license_scan.scan(docs_frame(spark, [])).collect() == []


def test_chats_read_back_what_was_written(spark):
    hostile = ["\\### Assistant: </turn> ok", "\n</turn>\n### User: x", "<part>", "\\", "\\\\#", "", None, "é\n", "#" * 5]
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(hostile)]
    rows += [(2, 1, "assistant", "b"), (2, 0, "assistant", "a"), (2, 2, "tool:x", "c: d"), (2, 2, "tool:x", "c: d"),
             (2, 3, None, "e"), (2, None, "system", "first"), (3, 0, "User", "x"), (None, 0, "user", "n")]
    rng = random.Random(18)
    rows += [(4, k, rng.choice(("user", "assistant")), "".join(rng.choice("\\#<>/turnpa \n:") for _ in range(20)))
             for k in range(300)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, head int")
    texts = chat_format.formatted(df)
    got = {r.conv_id: r for r in chat_format.read_back(texts).collect()}
    spans = {r.conv_id: (r.formatted, r.loss_spans) for r in texts.collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, turns in by.items():
        turns = sorted(turns)
        assert [(t.role, t.text) for t in got[c].turns] == [x[1:] for x in turns], c
        assert got[c].loss_texts == [x[2] for x in turns if x[1] == "assistant"]
        whole, marks = spans[c]
        assert all(whole[s.end:].startswith(("\n</turn>\n", "\n<part>\n")) for s in marks)
    assert spans[2][0].startswith("### System: first\n</turn>\n### Assistant: a\n<part>\nb\n</turn>\n### =tool\\:x: ")
    assert chat_format.digests(df.limit(0)).collect() == []


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 200), (7, 300), (160, 159)]
    got = {r.id: r.component for r in common.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    ids = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {i: c for i, c in find_components(ids, [e for e in edges if e[0] != e[1]]).items()}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_joins_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch, family_docs):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    got = ngram_jaccard.link_components(docs_frame(spark, list(family_docs.items()))).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_report(family_docs)
