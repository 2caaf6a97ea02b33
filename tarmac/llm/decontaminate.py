"""Benchmark passages in documents, with edits (q-gram lemma filtering and banded alignment).

Texts and items are compared as code points after ``str.lower`` and with every run of
white space as one blank. A document is contaminated by an item if a passage of
``PASSAGE`` code points of the item (the whole item if it is shorter) aligns with a
part of the document with at most ``EDIT_RATE`` edits per code point. Items of every length
are searched: a passage of under 40 code points is allowed as many edits, up to that rate, as
leave it one whole q-gram (none below 16), and an item of under ``Q`` code points must stand
in the document as it is, between characters that are neither letters nor digits.

1. A passage of length L with at most e edits keeps ``T = L - q + 1 - q * e`` of its
   q-grams, and the diagonals (document position less item position) on which they lie
   differ by at most e. Shared q-grams are counted per item and diagonal band; bands are
   ``2 * (e + 1)`` wide and start every ``e + 1``, so one band holds the alignment whole.
   A band with under T of them holds no match.
2. In a band that passes, each passage of the item with T shared q-grams inside it is a
   region to verify.
3. Regions are verified by edit distance in a diagonal band, a batch of regions at a
   time, free at both ends of the document part.

The index of the benchmark (one row per q-gram place) is broadcast in parts of at most
``PART_CODES`` code points, so its size is bounded whatever the benchmark holds; each
part is one pass over the documents and the passes' rows are united. No document is
shuffled in the search.

Defined cases: null or empty texts and items match nothing; repeated items count each;
rows with a null or repeated doc_id are reported under that id; other columns are kept
or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import mix64, sliding_runs, stored

Q = 8
PASSAGE = 100
EDIT_RATE = 0.1
PART_CODES = 4_000_000        # code points of the benchmark in one broadcast (about 100 MB)
CHUNK_CODES = 1 << 19
REGIONS = 4096                # regions aligned at a time
SLOTS, SPREAD = 1 << 20, 999_983   # counters of the first count of bands, which cells share
GAP = np.uint32(0xFFFFFFFF)   # no code point; more of them lie between documents than any budget
GAPS = np.full(int(EDIT_RATE * PASSAGE) + 2, GAP)
STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK = np.zeros(0x2030, bool)      # white space, by code point
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x2028, 0x2029]] = True


_EDGE = np.ones(0x3040, bool)        # code points that end a word; GAP and others beyond: see edges()
_EDGE[[c for c in range(0x3040) if chr(c).isalnum()]] = False


def edges(codes: np.ndarray) -> np.ndarray:
    """Which code points are neither letters nor digits (beyond U+303F only the gaps)."""
    return _EDGE[np.minimum(codes, np.uint32(len(_EDGE) - 1))] & (codes < len(_EDGE)) | (codes == GAP)


def budget(length: int) -> int:
    """Edits allowed in a passage: one of its q-grams at least stays whole."""
    return max(min(int(EDIT_RATE * length), length // Q - 1), 0)


def least_shared(length: int) -> int:
    """q-grams that a passage of this length keeps through its edit budget (q-gram lemma)."""
    return length - Q + 1 - Q * budget(length)


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased code points, each run of white space one blank, none at the ends."""
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32)
    blank = _BLANK[np.minimum(codes, np.uint32(len(_BLANK) - 1))]
    blank &= codes < len(_BLANK)
    if blank.any():
        codes = np.where(blank, np.uint32(32), codes)
        keep = np.ones(len(codes), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        codes = codes[keep]
        if len(codes) and codes[0] == 32:
            codes = codes[1:]
        if len(codes) and codes[-1] == 32:
            codes = codes[:-1]
    return codes


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for k in range(Q):
        h *= STEP
        h += wide[k: k + n]
    return mix64(h)


class Index:
    """q-grams of some items: hash → places (item, position)."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.codes = [], []
        hashes, item, place = [], [], []
        for item_id, text in items:
            codes = code_points(text)
            if not len(codes):
                continue
            k = len(self.ids)
            self.ids.append(item_id)
            self.codes.append(codes)
            h = gram_hashes(codes)
            hashes.append(h)
            item.append(np.full(len(h), k))
            place.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        h = h[order]
        at = sliding_runs(h)
        self.hashes, self.first, self.many = h[at], at, np.diff(np.append(at, len(h)))
        self.item = (np.concatenate(item) if item else np.zeros(0, np.int64))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int64))[order]
        self.filter = np.zeros(1 << self.FILTER_BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)] = True
        self.length = np.array([len(c) for c in self.codes], np.int64)
        self.short: dict[int, dict[bytes, list[int]]] = {}       # length → code points → items
        for k, c in enumerate(self.codes):
            if len(c) < Q:
                self.short.setdefault(len(c), {}).setdefault(c.tobytes(), []).append(k)

    def whole_words(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, position in ``codes``) of items of under ``Q`` code points."""
        if not self.short:
            return
        edge = np.concatenate(([True], edges(codes), [True]))    # edge[i]: the code point before i
        for size, items in self.short.items():
            at = np.flatnonzero(edge[: len(codes) - size + 1] & edge[size + 1:])
            if not len(at):
                continue
            grid = codes[at[:, None] + np.arange(size)[None, :]]
            for text, ks in items.items():
                same = (grid == np.frombuffer(text, np.uint32)).all(axis=1)
                for i in at[same].tolist():
                    for k in ks:
                        yield k, i

    def hits(self, codes: np.ndarray):
        """(position in ``codes``, item, position in the item) of every shared q-gram."""
        h = gram_hashes(codes)
        at = np.flatnonzero(self.filter[(h >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.hashes):
            none = np.zeros(0, np.int64)
            return none, none, none
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[k] == h[at]
        at, k = at[same], k[same]
        many = self.many[k]
        which = np.repeat(self.first[k], many) + (
            np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        return np.repeat(at, many), self.item[which], self.place[which]


def regions(index: Index, codes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(item, first position of a passage, its length, lowest diagonal of the band) of every
    passage with enough shared q-grams in one band."""
    at, item, place = index.hits(codes)
    if not len(at):
        return
    passage = np.minimum(index.length, PASSAGE)
    need = np.array([least_shared(int(n)) for n in passage], np.int64)
    width = np.array([budget(int(n)) + 1 for n in passage], np.int64)
    diagonal = at - place + index.length[item]                  # not negative
    base = 1 << 40
    cell = diagonal // width[item]
    slot = (item * SPREAD + cell) & (SLOTS - 1)                 # neighbouring cells, neighbouring slots
    count = np.bincount(slot, minlength=SLOTS)
    band = count + np.roll(count, 1)
    some = np.maximum(band[slot], band[(slot + 1) & (SLOTS - 1)]) >= need[item]
    if not some.any():
        return
    at, item, place, cell = at[some], item[some], place[some], cell[some]
    cell = item * base + cell
    bands = np.concatenate((cell, cell + 1))                    # band v is the cells v - 1 and v
    rows = np.concatenate((np.arange(len(at)), np.arange(len(at))))
    value, inverse, count = np.unique(bands, return_inverse=True, return_counts=True)
    pick = count[inverse] >= need[item[rows]]
    if not pick.any():
        return
    rows, inverse = rows[pick], inverse[pick]
    order = np.lexsort((place[rows], inverse))
    rows, inverse = rows[order], inverse[order]
    cut = sliding_runs(inverse)
    for a, b in zip(cut, np.append(cut[1:], len(inverse))):
        k = int(item[rows[a]])
        length, least = int(passage[k]), int(need[k])
        low = (int(value[inverse[a]]) - k * base - 1) * int(width[k]) - int(index.length[k])
        p = np.unique(place[rows[a:b]])
        first = np.arange(int(index.length[k]) - length + 1)
        shared = (np.searchsorted(p, first + length - Q, "right") - np.searchsorted(p, first))
        for f in first[shared >= least]:
            yield k, int(f), length, low


def banded_distance(pattern: np.ndarray, text: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row: least edits between the whole pattern row and a part of the text row whose
    alignment stays on the diagonals 0 .. width - 1 (text position less pattern position),
    and the text position at which such a part ends. ``text`` has pattern + width - 1 columns."""
    rows, m = pattern.shape
    width = text.shape[1] - m + 1
    cost = np.zeros((rows, width), np.int32)
    step = np.arange(width, dtype=np.int32)
    for i in range(m):
        change = cost + (text[:, i: i + width] != pattern[:, i: i + 1])
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)     # pattern position left out
        cost = np.minimum.accumulate(change - step, axis=1) + step       # text position put in
    end = cost.argmin(axis=1)
    return cost[np.arange(rows), end], end + m


def matches(index: Index, codes: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(item, passage start, passage length, edits, start, end) of verified regions of a chunk;
    start and end bound the part of ``codes`` within the band."""
    for k, at in index.whole_words(codes):
        size = int(index.length[k])
        yield k, 0, size, 0, at, at + size
    by_length: dict[int, list[tuple[int, int, int]]] = {}
    for k, first, length, low in regions(index, codes):
        by_length.setdefault(length, []).append((k, first, low))
    for length, todo in by_length.items():
        limit = budget(length)
        width = 4 * (limit + 1) + 1          # the band, and the drift of the alignment to either side
        for s in range(0, len(todo), REGIONS):
            part = todo[s: s + REGIONS]
            pattern = np.stack([index.codes[k][f: f + length] for k, f, _ in part])
            start = np.array([low + f - (limit + 1) for _, f, low in part])
            grid = start[:, None] + np.arange(length + width - 1)[None, :]
            inside = (grid >= 0) & (grid < len(codes))
            text = np.where(inside, codes[np.clip(grid, 0, len(codes) - 1)], GAP)
            edits, end = banded_distance(pattern, text, limit)
            for x in np.flatnonzero(edits <= limit):
                k, f, _ = part[x]
                stop = int(start[x] + end[x])
                yield k, f, length, int(edits[x]), max(stop - length, 0), stop


# ── Spark ─────────────────────────────────────────────────────────────

FOUND = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
                      T.StructField("edits", T.LongType()), T.StructField("passage", T.LongType()),
                      T.StructField("start", T.LongType())])


def benchmark_parts(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in parts of bounded size, read from a written table one part at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        F.length("text") >= 1)
    size = F.length("text")
    total, longest = items.agg(F.sum(size), F.max(size)).first()
    parts = -(-int(total or 0) // max(PART_CODES // 2, 1))
    if parts <= 1:
        yield [tuple(r) for r in items.collect()]        # at most half of PART_CODES code points
        return
    split = stored(items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * parts))),
                   "benchmark-parts")
    for k in range(2 * parts):
        yield [tuple(r) for r in split.where(F.col("part") == k).select("item_id", "text").collect()]


def search(docs: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
    """(doc_id, item_id, edits, passage, start): for each document and item that contaminates
    it, the least edits, and the passage's start in the item and about where it is in the text."""
    index = docs.sparkSession.sparkContext.broadcast(Index(items))

    def find(batches):
        ix = index.value
        schema = pa.schema([(f.name, pa.int64()) for f in FOUND])
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            k = 0
            while k < len(texts):
                parts, owner, size, begin = [], [], 0, [0]
                while k < len(texts) and (size < CHUNK_CODES or not parts):
                    c = code_points(texts[k].as_py())
                    if len(c):
                        parts += [c, GAPS]
                        owner.append(k)
                        size += len(c) + len(GAPS)
                        begin.append(size)
                    k += 1
                if not owner:
                    continue
                codes = np.concatenate(parts)
                best: dict[tuple[int, int], tuple] = {}
                for item, first, _, edits, start, end in matches(ix, codes):
                    d = int(np.searchsorted(begin, end - 1, "right")) - 1
                    row = (edits, first, max(start - begin[d], 0))
                    key = (owner[d], item)
                    if key not in best or row < best[key]:
                        best[key] = row
                if best:
                    rows = [(ids[d], pa.scalar(ix.ids[item], pa.int64()), *(pa.scalar(v, pa.int64()) for v in row))
                            for (d, item), row in best.items()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c].as_py() for r in rows], pa.int64()) for c in range(5)],
                        schema=schema)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(find, FOUND))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All matches, over every part of the benchmark."""
    found = None
    for items in benchmark_parts(benchmark):
        rows = search(docs, items)
        found = rows if found is None else found.unionByName(rows)
    return found


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, least_edits) for every row of ``docs``."""
    found = stored(contamination(docs, benchmark), "leaks")
    by_doc = found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.min("edits").alias("least_edits"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    out = rows.join(by_doc.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return out.select(
        "doc_id", F.col("least_edits").isNotNull().alias("contaminated"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), "least_edits")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates. The decision is made row by
    row (rows that share an id, or have none, are judged by their ids' worst text)."""
    found = stored(contamination(docs, benchmark).select("doc_id").distinct(), "leaky")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    kept = rows.join(found, F.col("id").eqNullSafe(F.col("doc_id")), "left_anti")
    return kept.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
