"""Kernels of the corpus operators against plain versions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from brute import best_segmentation, least_edits
from tarmac.llm import common, decontaminate, ego_join, kneser_ney, line_crf, ngram_jaccard, piece_viterbi
from tarmac.llm import suffix_dedup, warc


def test_words_and_spans_of_chunks():
    texts = ["Ab  c", None, "", "\tx\n", "é\x0bé"]
    (i, j, buf, offs), = common.utf8_chunks(pa.array(texts, pa.string()))
    starts, ends, first = common.word_spans(buf, offs)
    words = [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)]
    assert (i, j, words, first.tolist()) == (0, 5, ["Ab", "c", "x", "é", "é"], [0, 2, 2, 2, 3, 5])
    h = common.SpanHash(buf, common.byte_codes(fold_case=False))(starts, ends)
    assert h[3] == h[4] and len(set(h.tolist())) == 4


def test_chunks_cover_all_rows_and_slices():
    texts = pa.array(["a" * k for k in range(60)])
    got = [bytes(b[o[k]: o[k + 1]]).decode() for _, _, b, o in common.utf8_chunks(texts.slice(5, 40), 100)
           for k in range(len(o) - 1)]
    assert got == texts.slice(5, 40).to_pylist()


def test_shingle_sets_fold_case_and_keep_short_texts_apart():
    sets = list(ngram_jaccard.shingle_sets(pa.array(["A b c d e", "a  B\nc d E", "a b c d", "a b", "", None])))
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0]
    assert sets[0][0] == sets[1][0] and len({s[0] for s in sets[:4]}) == 3


def test_overlap_bound_holds_across_resolutions():
    rng = np.random.default_rng(1)
    for n, m in ((40, 50), (100, 130), (700, 900), (3000, 2500)):
        a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate((a[: len(a) // 2], rng.integers(0, 1 << 63, m, np.uint64))))
        pa_, pb = (ngram_jaccard.unpack_point(ngram_jaccard.fine_point(x), len(x)) for x in (a, b))
        assert ngram_jaccard.overlap_bound(pa_, pb) >= len(np.intersect1d(a, b))
        assert ngram_jaccard.overlap_bound(pa_, pa_) == len(a)


def test_count_tree_finds_every_pair_the_bound_allows():
    rng = np.random.default_rng(2)
    base = rng.poisson(3, (12, ngram_jaccard.GROUPS))
    points = np.abs(base[rng.integers(0, 12, 300)] + rng.integers(-1, 2, (300, ngram_jaccard.GROUPS))).astype(np.int32)
    n = points.sum(axis=1).astype(np.int64)
    order = np.argsort(n)
    points, n = points[order], n[order]
    ids = np.arange(300)
    got = {(int(r[0]), int(r[1])) for p in ngram_jaccard.block_pairs(ids, n, ids, ids, points) for r in p}
    both = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if 175 * both[i, j] >= 75 * (n[i] + n[j])}
    assert got == want and want


def test_sliding_minimum():
    rng = np.random.default_rng(3)
    for n, w in ((1, 1), (10, 3), (201, 201), (1000, 201)):
        v = rng.integers(0, 1 << 60, n).astype(np.uint64)
        assert suffix_dedup.sliding_min(v, w).tolist() == [v[k: k + w].min() for k in range(n - w + 1)]


def test_deep_shallow_orders_like_sorted_and_gives_common_prefixes():
    rng = random.Random(4)
    groups, strings = [], []
    for g in range(20):
        stem = bytes(rng.choice(b"ab") for _ in range(150))
        for _ in range(rng.choice((1, 2, 9, 40))):
            s = bytearray(stem[: rng.choice((5, 40, 150))])
            if len(s) > 60 and rng.random() < 0.7:
                s[rng.randrange(33, len(s))] = rng.choice(b"abc")
            groups.append(g)
            strings.append(bytes(s))
    size = np.array([len(s) for s in strings])
    text = np.zeros((len(strings), suffix_dedup.SIDE), np.uint8)
    for k, s in enumerate(strings):
        text[k, : len(s)] = np.frombuffer(s, np.uint8)
    order, lcp = suffix_dedup.deep_shallow(np.array(groups), text, size)
    got = [(groups[k], strings[k]) for k in order]
    assert got == sorted(got)
    for k in range(1, len(got)):
        a, b = got[k - 1], got[k]
        want = -1 if a[0] != b[0] else next((x for x in range(min(len(a[1]), len(b[1]))) if a[1][x] != b[1][x]),
                                            min(len(a[1]), len(b[1])))
        assert lcp[k] == want
    assert lcp[0] == -1


def test_banded_distance_is_the_edit_distance_within_the_band():
    rng = random.Random(5)
    for _ in range(40):
        p = [rng.randrange(3) for _ in range(20)]
        t = p[:]
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(t))
            rng.choice((lambda: t.__setitem__(k, 9), lambda: t.pop(k), lambda: t.insert(k, 9)))()
        t = [7] * 8 + t + [8] * 12
        width = 17
        grid = np.array([(t + [99] * 40)[: 20 + width - 1]])
        got, _ = decontaminate.banded_distance(np.array([p]), grid, 4)
        assert got[0] == least_edits(p, t)


@pytest.mark.parametrize("seed", range(6))
def test_passages_with_edits_are_found_exactly_within_budget(seed):
    rng = random.Random(seed)
    items = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice((45, 90, 100, 180)))).strip() for _ in range(8)]
    index = decontaminate.Index(list(enumerate(items)))
    for _ in range(5):
        k = rng.randrange(8)
        part = list(items[k][rng.randrange(max(1, len(items[k]) - 110)):][:110])
        for _ in range(rng.choice((0, 2, 5, 9, 10, 11, 13))):
            at = rng.randrange(len(part))
            rng.choice((lambda: part.__setitem__(at, "z"), lambda: part.pop(at), lambda: part.insert(at, "z")))()
        doc = "".join(rng.choice("abcdefgh ") for _ in range(40)) + "".join(part) + "xyz" * 9
        codes = decontaminate.code_points(doc)
        got = {}
        for m in decontaminate.matches(index, np.concatenate([codes, decontaminate.GAPS])):
            got[m[0]] = min(got.get(m[0], 99), m[3])
        want = {}
        for i, c in enumerate(index.codes):
            n = min(decontaminate.PASSAGE, len(c))
            starts = range(len(c) - n + 1) if i == k else range(0, len(c) - n + 1, 29)
            e = min(least_edits(c[f: f + n].tolist(), codes.tolist()) for f in starts)
            if e <= decontaminate.budget(n):
                want[i] = e
        assert got == want


def test_links_and_local_components_of_intervals():
    rng = np.random.default_rng(6)
    c = rng.normal(size=(6, 16))
    x = ego_join.unit(c[rng.integers(0, 6, 150)] + 0.12 * rng.normal(size=(150, 16)))
    known = {16: np.linalg.qr(rng.normal(size=(16, 16)))[0][:, : ego_join.DIMENSIONS]}
    p = ego_join.project(x, known)
    assert (ego_join.linked(x, x, p, p) == (x @ x.T >= ego_join.COSINE)).all()
    link = np.array([[True, False], [True, False], [False, True]])
    low = ego_join.local_components(link, np.array([5, 9, 7]), np.array([6, 3]))
    assert [v.tolist() for v in low] == [[5, 5, 3], [5, 3]]


def test_forward_backward_against_all_labelings():
    from itertools import product
    rng = np.random.default_rng(7)
    first = np.array([0, 1, 4, 9])
    e, moves = rng.normal(size=9), rng.normal(size=(2, 2))
    good, expected = line_crf.marginals(e, first, moves)
    total = np.zeros((2, 2))
    for a, b in zip(first[:-1], first[1:]):
        z, p, m = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in product((0, 1), repeat=b - a):
            w = np.exp(sum(e[a + k] for k in range(b - a) if y[k]) + sum(moves[y[k - 1], y[k]] for k in range(1, b - a)))
            z += w
            p += w * np.array(y)
            for k in range(1, b - a):
                m[y[k - 1], y[k]] += w
        assert np.allclose(good[a:b], p / z)
        total += m / z
    assert np.allclose(expected, total)


def test_line_bins_split_at_line_breaks():
    (_, _, buf, offs), = common.utf8_chunks(pa.array(["a\n\nb b", "", "ÉÉ\n"]))
    bins, size, first, _ = line_crf.line_bins(buf, offs)
    assert size.tolist() == [1, 0, 3, 0, 4, 0] and first.tolist() == [0, 3, 4, 6]
    assert bins[4][0] == 3 and bins[0][0] == 0               # all capitals; none
    assert bins[2][10] > 0 and bins[2][11] > 0               # a word twice


def test_grams_spell_words_with_start_and_end():
    sym, offs = kneser_ney.symbols(["Ab a, AB", None or "", "é"])
    h, start, size, which, first = kneser_ney.words(sym, offs)
    assert len(h) == 3 and first.tolist() == [0, 3, 3, 4] and which[0] == which[2]
    g, word = kneser_ney.grams(sym, start[which[:1]], size[which[:1]], 3)
    s, e = kneser_ney.START, kneser_ney.END
    assert g.tolist() == [(a << 12) | (b << 6) | c for a, b, c in ((s, s, 1), (s, 1, 2), (1, 2, e))]


def test_segmentation_is_the_best_and_round_trips():
    lexicon = piece_viterbi.Lexicon()
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=piece_viterbi.MODEL_PATH)
    pieces = {m.id_to_piece(i).replace("▁", " "): m.get_score(i) for i in range(m.get_piece_size())
              if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}
    texts = ["", None, " ", "the thandedble erest", "a\n\nb ", "  two", "日本\U0001F600x", "Üß élan", "a" * 900, "x\r\n\ty",
             "no" * 40, "0 12 345"]
    rng = random.Random(8)
    texts += ["".join(rng.choice("abhent \n") for _ in range(30)) for _ in range(60)]
    ids = piece_viterbi.encode_array(lexicon, pa.array(texts, pa.string()))
    assert piece_viterbi.decode_array(lexicon, ids).to_pylist() == [t or "" for t in texts]
    unknown = lexicon.unknown_score
    for t, i in zip(texts, ids.to_pylist()):
        if t and len(t) < 60 and t.isascii() and "\n" not in t:
            assert sum(m.get_score(k) for k in i) == best_segmentation(" " + t, pieces, unknown)
    assert piece_viterbi.encode_array(lexicon, pa.array(["x▁y"])).to_pylist() == \
        piece_viterbi.encode_array(lexicon, pa.array(["x y"])).to_pylist()


def test_archive_parser_trusts_lengths_not_contents():
    block = b"HTTP/1.1 200 OK\r\n\r\n" + b"\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n"
    record = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Type: application/http;msgtype=response"
              b"\r\nContent-Length: %d\r\n\r\n" % len(block)) + block + b"\r\n\r\n"
    rows = list(warc.parse_archive(record * 3))
    assert len(rows) == 3 and rows[0][0] == "response" and rows[0][8] == block[19:]
    with pytest.raises(ValueError):
        list(warc.parse_archive(record[:-30]))
