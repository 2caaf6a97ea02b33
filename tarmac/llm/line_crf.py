"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good (1) or bad (0). Its evidence is a sum of weights of
binned features of the line and of its two neighbours; neighbouring labels share
transition weights. Forward-backward gives each line's marginal probability of being
good; their mean, weighted by line length, is calibrated into the score.

Training: labels mark documents, so all lines of a labelled document carry its label.
The model is fitted on at most ``TRAIN_DOCS`` labelled documents (those with the least
hash of doc_id, a bounded sample that any order of the rows gives) of which none is held
out (crc32 of doc_id mod ``FOLDS`` = ``HELD_OUT_FOLD``). Their features, not their texts,
go to the driver: ``FEATURES`` bytes a line. Scoring reads the text only and is one
pass without a shuffle.

Defined cases: a null or empty text is one empty line; blank lines are lines; a null
doc_id is scored and not held out, and never trains; doc_ids that repeat in the labels
count as bad if any row says so; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SpanHash, byte_codes, utf8_chunks, word_spans

TRAIN_DOCS = 4000
FOLDS, HELD_OUT_FOLD = 4, 2
THRESHOLD = 0.7
STEPS, RATE, RIDGE = 120, 0.15, 2.0

# Features of a line: the edges between their bins.
EDGES = [
    ("capitals per letter", (0.02, 0.15, 0.5)),
    ("symbols per byte", (0.005, 0.03, 0.1)),
    ("exclamation marks per byte", (0.0001, 0.01, 0.05)),
    ("bars per byte", (0.0001, 0.01, 0.05)),
    ("digits per byte", (0.001, 0.03, 0.15)),
    ("blanks per byte", (0.1, 0.2, 0.3)),
    ("stops and commas per byte", (0.005, 0.03, 0.08)),
    ("bytes per word", (3.0, 5.0, 7.5)),
    ("bytes", (1.0, 20.0, 80.0)),
    ("words", (1.0, 4.0, 15.0)),
    ("words like the one before", (0.001, 0.1, 0.4)),
    ("words like an earlier one of the line", (0.05, 0.3, 0.6)),
]
FEATURES, BINS, SEATS = len(EDGES), 4, 3          # seats: the line, the one before, the one after
NONE = BINS                                       # bin of a neighbour that isn't there


def _byte_set(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC0:] = True                             # first byte of a character beyond ASCII
_SYMBOL = _byte_set("#$%&*+/<=>@[\\]^_`{}~")
_STOP = _byte_set(".,;:")
_DIGIT = _byte_set("0123456789")
_BLANK = _byte_set(" \t\r\v\f")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


# ── features ──────────────────────────────────────────────────────────


def line_bins(buf: np.ndarray, offs: np.ndarray):
    """(bins of each line, bytes of each line, first line of each document) of a chunk."""
    n, docs = len(buf), len(offs) - 1
    breaks = np.flatnonzero(buf == 10)
    starts = np.sort(np.concatenate((offs[:-1], breaks + 1)), kind="stable")
    before = np.searchsorted(breaks, offs[:-1])
    first = np.append(before + np.arange(docs), len(starts))
    owner = np.repeat(np.arange(docs), np.diff(first))
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1                    # up to the line break
    last = first[1:] - 1
    ends[last] = offs[1:]
    size = (ends - starts).astype(np.float64)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int32)
        np.cumsum(mask, out=total[1:], dtype=np.int32)
        return (total[ends] - total[starts]).astype(np.float64)

    upper = _UPPER[buf]
    if n > 1:                                     # capitals of Latin letters with marks
        upper[1:] |= (buf[:-1] == 0xC3) & (buf[1:] < 0x9F) & (buf[1:] >= 0x80)
    letters = count(_LETTER[buf])
    w_start, w_end, _ = word_spans(buf, offs)
    line = np.searchsorted(starts, w_start, "right") - 1
    words = np.bincount(line, minlength=len(starts)).astype(np.float64)
    length = np.bincount(line, weights=w_end - w_start, minlength=len(starts))
    twin = np.zeros(len(starts))
    again = np.zeros(len(starts))
    if len(w_start):
        h = SpanHash(buf, byte_codes(fold_case=True))(w_start, w_end)
        same = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        twin = np.bincount(line[1:][same], minlength=len(starts)).astype(np.float64)
        order = np.lexsort((h, line))
        same = (h[order][1:] == h[order][:-1]) & (line[order][1:] == line[order][:-1])
        again = np.bincount(line[order][1:][same], minlength=len(starts)).astype(np.float64)
    whole, words_1 = np.maximum(size, 1), np.maximum(words, 1)
    values = [count(upper) / np.maximum(letters, 1), count(_SYMBOL[buf]) / whole,
              count(buf == 33) / whole, count(buf == 124) / whole, count(_DIGIT[buf]) / whole,
              count(_BLANK[buf]) / whole, count(_STOP[buf]) / whole, length / words_1,
              size, words, twin / words_1, again / words_1]
    bins = np.stack([np.searchsorted(edges, v, "right") for (_, edges), v in zip(EDGES, values)],
                    axis=1).astype(np.uint8)
    return bins, size, first, owner


def seated(bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bins of each line, of the one before and of the one after it in its document."""
    out = np.full((len(bins), SEATS, FEATURES), NONE, np.uint8)
    out[:, 0] = bins
    out[1:, 1] = bins[:-1]
    out[:-1, 2] = bins[1:]
    out[first[:-1], 1] = NONE
    out[first[1:] - 1, 2] = NONE
    return out


# ── chain ─────────────────────────────────────────────────────────────


@dataclass
class Model:
    weights: np.ndarray          # seat x feature x bin: evidence for a good line
    bias: float
    moves: np.ndarray            # 2 x 2: from label, to label
    slope: float = 1.0
    shift: float = 0.0

    def evidence(self, seats: np.ndarray) -> np.ndarray:
        out = np.full(len(seats), self.bias)
        for s in range(SEATS):
            for f in range(FEATURES):
                out += self.weights[s, f][seats[:, s, f]]
        return out


def _steps(first: np.ndarray):
    """Documents by falling number of lines, and how many of them have a t-th line."""
    lines = np.diff(first)
    order = np.argsort(-lines, kind="stable")
    return order, lines[order], [int(k) for k in
                                 np.searchsorted(-lines[order], -np.arange(lines.max(initial=0)), "left")]


def _join(a: np.ndarray, moves: np.ndarray) -> np.ndarray:
    return np.stack([np.logaddexp(a[:, 0] + moves[0, y], a[:, 1] + moves[1, y]) for y in (0, 1)], axis=1)


def marginals(evidence: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """Probability of each line to be good, and the expected number of each move."""
    order, lines, active = _steps(first)
    begin = first[:-1][order]
    node = np.stack((np.zeros(len(evidence)), evidence), axis=1)
    ahead, back = np.zeros_like(node), np.zeros_like(node)
    for t, k in enumerate(active):
        at = begin[:k] + t
        ahead[at] = node[at] + (_join(ahead[at - 1], moves) if t else 0)
    turned = moves.T
    for t in range(len(active) - 2, -1, -1):
        k = active[t + 1]
        at = begin[:k] + t
        back[at] = _join(back[at + 1] + node[at + 1], turned)
    both = ahead + back
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))
    expected = np.zeros((2, 2))
    later = np.ones(len(evidence), bool)
    later[first[:-1]] = False
    at = np.flatnonzero(later)
    if len(at):
        total = np.logaddexp(both[at, 0], both[at, 1])
        for x in (0, 1):
            for y in (0, 1):
                expected[x, y] = np.exp(ahead[at - 1, x] + moves[x, y] + node[at, y] + back[at, y] - total).sum()
    return good, expected


def document_means(good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
    weight = size + 1                              # an empty line weighs something
    return np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1])


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(bins: np.ndarray, size: np.ndarray, first: np.ndarray, label: np.ndarray) -> Model | None:
    """Conditional likelihood of the lines' labels, climbed by Adam; then the calibration."""
    if len(label) == 0 or label.min() == label.max():
        return None
    seats = seated(bins, first)
    owner = np.repeat(np.arange(len(label)), np.diff(first))
    y = label[owner].astype(np.float64)
    later = np.ones(len(y), bool)
    later[first[:-1]] = False
    moved = np.zeros((2, 2))
    np.add.at(moved, (y[np.flatnonzero(later) - 1].astype(int), y[later].astype(int)), 1)
    shape = (SEATS, FEATURES, BINS + 1)
    theta = np.zeros(np.prod(shape) + 1 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    cut = len(theta) - 5
    for step in range(1, STEPS + 1):
        model = Model(theta[:cut].reshape(shape), theta[cut], theta[cut + 1:].reshape(2, 2))
        good, expected = marginals(model.evidence(seats), first, model.moves)
        rest = y - good
        grad = [np.bincount(seats[:, s, f], rest, BINS + 1) for s in range(SEATS) for f in range(FEATURES)]
        g = np.concatenate([*grad, [rest.sum()], (moved - expected).ravel()]) - RIDGE * theta
        g /= len(y)
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    model = Model(theta[:cut].reshape(shape).copy(), float(theta[cut]), theta[cut + 1:].reshape(2, 2).copy())
    good, _ = marginals(model.evidence(seats), first, model.moves)
    x = _logit(document_means(good, size, first))
    a, b = 1.0, 0.0
    for _ in range(30):                            # logistic calibration by Newton's method
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w = p * (1 - p) + 1e-9
        g = np.array([((label - p) * x).sum() - 0.1 * (a - 1), (label - p).sum() - 0.1 * b])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        d = np.linalg.solve(h, g)
        a, b = a + float(d[0]), b + float(d[1])
    model.slope, model.shift = max(a, 1e-3), b     # more good lines never lower the score
    return model


# ── Spark ─────────────────────────────────────────────────────────────


def training_ids(labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, label) of the bounded training sample."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
            .where("doc_id is not null and label in (0, 1)")
            .where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
            .groupBy("doc_id").agg(F.min("label").alias("label"))
            .orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id").limit(limit))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    def features(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int64()), ("bins", pa.binary()),
                            ("size", pa.binary())])
        for batch in batches:
            out_bins, out_size = [], []
            for i, j, buf, offs in utf8_chunks(batch.column(2)):
                bins, size, first, _ = line_bins(buf, offs)
                for a, b in zip(first[:-1], first[1:]):
                    out_bins.append(bins[a:b].tobytes())
                    out_size.append(size[a:b].astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out_bins, pa.binary()),
                 pa.array(out_size, pa.binary())], schema=schema)

    ids = F.broadcast(training_ids(labels))        # at most TRAIN_DOCS rows
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
            .select("doc_id", F.col("label").cast("long").alias("label"), "text")
            .mapInArrow(features, "doc_id long, label long, bins binary, size binary").toPandas()
            .drop_duplicates(["doc_id", "bins"]).sort_values(["doc_id", "bins"]))
    if not len(rows):
        return None
    bins = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(-1, FEATURES)
    size = np.frombuffer(b"".join(rows["size"]), "<f8")
    first = np.concatenate(([0], np.cumsum([len(s) // 8 for s in rows["size"]])))
    return fit(bins, size, first, rows["label"].to_numpy())


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with its columns and ``score``."""
    schema = docs.schema
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")

    def score(batches):
        crf = shared.value
        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            if crf is not None:
                for i, j, buf, offs in utf8_chunks(batch.column(text_at)):
                    bins, size, first, _ = line_bins(buf, offs)
                    good, _ = marginals(crf.evidence(seated(bins, first)), first, crf.moves)
                    x = crf.slope * _logit(document_means(good, size, first)) + crf.shift
                    out[i:j] = 1 / (1 + np.exp(-np.clip(x, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out)], [*batch.schema.names, "score"])

    return docs.mapInArrow(score, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, "
                                  "`score` double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    model = train(docs, labels)
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least ``THRESHOLD``. Without a model (no labels of
    both kinds) nothing is rejected."""
    model = train(docs, labels)
    if model is None:
        return docs
    names = [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*["text" if c == "text" else n for c, n in zip(docs.columns, names)])
    return scored(plain, model).where(F.col("score") >= THRESHOLD).drop("score").toDF(*docs.columns)
