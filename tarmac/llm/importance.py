"""Draw of documents towards a target's word distribution (importance resampling).

Words are runs of digits, letters ``a-z`` and code points of 128 and more, after A-Z are
lower-cased. A document's features are its runs of 1 to ``LONGEST`` consecutive words
joined by a blank, repeats counted; a feature's bucket is the unsigned crc32 of its UTF-8
bytes modulo ``BUCKETS``. With S features of all documents, s of them in a bucket, and T
and t those of the target texts, the bucket's gain is
``floor(1000 * ln((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS))))``. A document's
weight is the floored mean of its features' gains (none: 0), its score the weight plus
``floor(-1000 * ln(-ln((h + 0.5) / 2^32)))`` with h the first 8 hex digits of
``sha256("<seed>:<doc_id>")``. Of the N documents of at least ``LEAST_WORDS`` words the
``floor(PERCENT * N / 100)`` of the highest scores are drawn, ties to the smaller doc_id.

1. Tasks count buckets: numpy finds the words of a chunk of texts as byte spans and runs
   the crc32 of all spans side by side, a byte a step. A task sends one row per bucket.
2. The ``BUCKETS`` gains are an array every task holds (its size doesn't follow the data).
   A second pass over the texts adds the gains up, and its rows
   ``(row, doc_id, n_features, n_words, weight, score)`` are written.
3. The cutoff is found by bisection on these rows: each job counts exactly how many rows
   lie at or above each of ``PROBES`` evenly spaced values between the bounds, which leaves
   one of the intervals. First the score, then, among the rows tied at it, the doc_id.
   The driver sees counts only.
4. Drawn rows are dealt by ranges of (score, doc_id) and sorted; a row's rank is its place
   in its range plus the sizes of the ranges before. The others need no exchange.

Defined cases: null and empty texts have no features and weight 0. A null doc_id stands as
the empty string in the hash and after all ids in a tie. Of tied rows with one doc_id those
read first are drawn (equal rows cannot be told apart). Without target texts T is 0; an
empty table draws nothing. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored, utf8_chunks

LONGEST, BUCKETS = 1, 10_000
LEAST_WORDS, PERCENT, SEED = 20, 10, 2024
PROBES = 31                   # values counted in one job: five halvings
SIDE_BY_SIDE = 128            # bytes of a word that are hashed side by side with other words

INK = np.zeros(256, bool)
INK[48:58] = INK[65:91] = INK[97:123] = INK[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _crc_table()


def words(buf: np.ndarray, offs: np.ndarray):
    """Starts and ends of the words of a chunk, and each document's first word."""
    n = len(buf)
    ink = np.zeros(n + 2, bool)
    ink[1:-1] = INK[buf]
    same = np.ones(n + 1, bool)              # does a byte belong to the document of the one before
    same[offs] = False
    starts = np.flatnonzero(ink[1:-1] & ~(ink[:-2] & same[:n]))
    ends = np.flatnonzero(ink[1:-1] & ~(ink[2:] & same[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def crc32_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                state: np.ndarray | None = None) -> np.ndarray:
    """Register of the crc32 of every span, going on from ``state``. Spans are sorted by
    length, so step k touches those of more than k bytes only."""
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32) if state is None else state.copy()
    if not len(starts):
        return crc
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, reg = starts[order], crc[order]
    many = np.searchsorted(-size[order], -np.arange(min(int(size.max()), SIDE_BY_SIDE)), "left")
    for k, m in enumerate(many):
        reg[:m] = CRC[(reg[:m] ^ buf[at[:m] + k]) & 255] ^ (reg[:m] >> np.uint32(8))
    crc[order] = reg
    for i in np.flatnonzero(size > SIDE_BY_SIDE):
        rest = buf[starts[i] + SIDE_BY_SIDE: ends[i]].tobytes()
        crc[i] = zlib.crc32(rest, int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return crc


def feature_buckets(buf: np.ndarray, offs: np.ndarray, longest: int, buckets: int):
    """(document, bucket) of all features of a chunk, and each document's words."""
    buf = LOWER[buf]
    starts, ends, first = words(buf, offs)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    docs, found = [], []
    reg = None
    blank = np.full(1, 32, np.uint8)
    for k in range(longest):
        m = len(starts) - k
        ok = np.flatnonzero(owner[:m] == owner[k:]) if m > 0 else np.zeros(0, np.int64)
        if k:                                 # one word longer: blank and next word
            reg = reg[np.searchsorted(kept, ok)]
            zero = np.zeros(len(ok), np.int64)
            reg = crc32_spans(blank, zero, zero + 1, reg)
        reg = crc32_spans(buf, starts[ok + k], ends[ok + k], reg)
        kept = ok
        docs.append(owner[ok])
        found.append(((reg ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(found), n_words


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often features of all texts fall in each bucket."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, buf, offs in utf8_chunks(batch.column(0)):
                total += np.bincount(feature_buckets(buf, offs, longest, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return (texts.select("text").mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST,
                 buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket; ``buckets`` pairs of counts reach the driver."""
    found = (bucket_counts(docs, longest, buckets).withColumn("of", F.lit(0))
             .unionByName(bucket_counts(target, longest, buckets).withColumn("of", F.lit(1))))
    n = np.zeros((2, buckets), np.int64)
    for r in found.collect():
        n[r["of"], r["bucket"]] = r["n"]
    big, want = (int(x) for x in n.sum(axis=1))
    return np.array([math.floor(1000 * math.log((t + 1) * (big + buckets) / ((s + 1) * (want + buckets))))
                     for s, t in zip(n[0].tolist(), n[1].tolist())], np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """``floor(-1000 * ln(-ln(u)))`` with u the hash of seed and id, between 0 and 1."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """(row, doc_id, n_features, n_words, weight, score) of every document, written."""
    buckets = len(gains)

    def score(batches):
        for batch in batches:
            cols: list[list[np.ndarray]] = [[], [], []]
            for _, _, buf, offs in utf8_chunks(batch.column(1)):
                owner, bucket, n_words = feature_buckets(buf, offs, longest, buckets)
                n = np.bincount(owner, minlength=len(n_words)).astype(np.int64)
                total = np.bincount(owner, gains[bucket], len(n_words)).astype(np.int64)   # exact below 2^53
                for c, v in zip(cols, (n, n_words.astype(np.int64), total // np.maximum(n, 1))):
                    c.append(v)
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(np.concatenate(c)) for c in cols)],
                    ["doc_id", "n_features", "n_words", "weight"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(score, "doc_id long, n_features long, n_words long, weight long"))
    return stored(rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
                  .withColumn("row", F.monotonically_increasing_id()), "importance-scores")


def largest_with(rows: DataFrame, value: Column, least: int) -> int:
    """The largest v for which at least ``least`` (>= 1, at most all) rows have ``value >= v``.
    Every job counts at ``PROBES`` values and leaves the interval between two of them."""
    lo, top = rows.agg(F.min(value), F.max(value)).first()
    hi = top + 1                             # at lo there are enough rows, at hi too few
    while hi - lo > 1:
        n = min(PROBES, hi - lo - 1)
        at = [lo + (hi - lo) * (k + 1) // (n + 1) for k in range(n)]
        counts = rows.agg(*(F.count_if(value >= F.lit(v)).alias(f"n{k}") for k, v in enumerate(at))).first()
        for v, c in zip(at, counts):
            if c >= least:
                lo = v
            else:
                hi = v
                break
    return lo


def drawn(rows: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``rows`` of ``scored`` with ``rank`` (1, 2, ...; null: not drawn)."""
    spark = rows.sparkSession
    able = F.col("n_words") >= least_words
    n_draw = percent * rows.where(able).count() // 100
    none = rows.withColumn("rank", F.lit(None).cast("long"))
    if not n_draw:
        return none
    pool = rows.where(able)
    cut = largest_with(pool, F.col("score"), n_draw)
    above = pool.where(F.col("score") > cut).count()
    # ids go down as ranks go up; null ids come last
    tied = stored(pool.where(F.col("score") == cut).select("doc_id"), "importance-ties")
    open_places = n_draw - above
    if tied.where("doc_id is not null").count() >= open_places:
        last = -largest_with(tied.where("doc_id is not null"), -F.col("doc_id"), open_places)
        at_cut = F.coalesce(F.col("doc_id") <= last, F.lit(False))
    else:
        at_cut = F.lit(True)
    inside = able & ((F.col("score") > cut) | ((F.col("score") == cut) & at_cut))
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_draw))
    keys = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    ranged = stored(rows.where(inside).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                    .withColumn("at", F.monotonically_increasing_id()), "importance-drawn")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r["part"]: r["n"] for r in ranged.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts, total = [], 0
    for p in range(max(sizes) + 1):          # as many numbers as ranges
        starts.append(total)
        total += sizes.get(p, 0)
    start = spark.createDataFrame(list(enumerate(starts)), "part long, start long")
    rank = F.col("start") + place + 1
    ranked = (ranged.withColumn("part", part).join(F.broadcast(start), "part")
              .withColumn("rank", F.when(rank <= n_draw, rank)).select(*rows.columns, "rank"))
    return ranked.unionByName(none.where(~inside))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document."""
    gains = bucket_gains(docs, target, longest, buckets)
    return (drawn(scored(docs, gains, longest, seed), percent, least_words)
            .select("doc_id", "n_features", "weight", "score", "rank"))
