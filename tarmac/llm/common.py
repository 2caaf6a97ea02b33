"""Helpers shared by the corpus operators: table access, byte kernels, components.

The byte kernels work on one chunk of documents at a time (a few MB), so the
memory of a task does not follow its partition. Span hashes are polynomial
hashes modulo 2^64 over a random 64-bit code per byte, finished with a mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import scratch_path

CHUNK_BYTES = 1 << 20
MIX_A, MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15            # odd, so it has an inverse modulo 2^64
_S33 = np.uint64(33)


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, and the path, for ``without_table``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def without_table(spark: SparkSession, path: str) -> None:
    """Delete a written table that no later step reads."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


BROADCAST_ROWS = 1_000_000


def rows_with_ids(df: DataFrame, ids: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """``df`` joined with ``ids`` (distinct ``key``, maybe with small columns). The ids are
    written and counted first: up to ``BROADCAST_ROWS`` they go to the rows, beyond that
    both sides are shuffled."""
    ids = stored(ids, "ids")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return df.join(ids, key, how)


# ── bytes ─────────────────────────────────────────────────────────────


def utf8_chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows; null counts as empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    _, off, data = col.buffers()
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(off, np.int64)[col.offset: col.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, buf[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _S33)
    h = h * MIX_A
    h ^= h >> _S33
    h *= MIX_B
    h ^= h >> _S33
    return h


class SpanHash:
    """Hashes of byte spans of one chunk in O(1) each."""

    _powers: tuple[np.ndarray, np.ndarray] | None = None

    def __init__(self, buf: np.ndarray, codes: np.ndarray):
        n = len(buf)
        up, self.down = self._tables(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[buf] * up[:n], out=self.total[1:])

    @classmethod
    def _tables(cls, n: int):
        if cls._powers is None or len(cls._powers[0]) < n:
            size = max(n, CHUNK_BYTES + 1)
            both = []
            for base in (BASE, pow(BASE, -1, 1 << 64)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p, dtype=np.uint64))
            cls._powers = (both[0], both[1])
        return cls._powers

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.total[end] - self.total[start]) * self.down[start])


def byte_codes(fold_case: bool) -> np.ndarray:
    """A fixed random 64-bit code per byte; with ``fold_case``, A-Z share those of a-z."""
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if fold_case:
        codes[65:91] = codes[97:123]
    return codes


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(buf: np.ndarray, offs: np.ndarray):
    """Start and end of every word ``[^\\x20\\x09-\\x0D]+`` and each document's first word."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offs), np.int64)
    ink = ~BLANK[buf]
    before = np.zeros(n, bool)
    before[1:] = ink[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = ink[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts = np.flatnonzero(ink & ~before)
    ends = np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def sliding_runs(values: np.ndarray) -> np.ndarray:
    """Index of the first element of each run of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))


# ── components ────────────────────────────────────────────────────────


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on ``edges(a, b)``: rows are read sorted by node and neighbour, so a node's
    least neighbour comes first and nothing is held. Large: from every node its greater
    neighbours are tied to the least node it knows. Small: so are its smaller neighbours and
    itself (``edges`` with a > b)."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def tie(batches):
        last = None                  # (node, neighbour, least) of the row before
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.ones(len(a), bool)
            new[1:] = a[1:] != a[:-1]
            fresh = new.copy()
            fresh[1:] |= b[1:] != b[:-1]
            goes_on = last is not None and last[0] == a[0]
            if goes_on:
                new[0] = False
                fresh[0] = last[1] != b[0]
            at = np.flatnonzero(new)
            low = np.minimum(a[at], b[at])
            which = np.cumsum(new) - 1
            if goes_on:
                low, which = np.concatenate(([last[2]], low)), which + 1
            least = low[which]
            last = (a[-1], b[-1], least[-1])
            if large:
                ok = fresh & (b > a)
                x = b
            else:
                ok = fresh
                x = np.where(new, a, b)
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]), pa.array(least[ok])], ["a", "b"])

    return (edges.repartition("a").sortWithinPartitions("a", "b").select("a", "b")
            .mapInArrow(tie, "a long, b long"))


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges(a, b)`` (long): rows ``(id, component)``.

    ``component`` is the smallest id reachable. Alternating large-star and small-star steps,
    one exchange each; a round of two of both ends in a written table, and only three sums
    of it reach the driver. Ids without an edge are not in the result.
    """
    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"),
                     F.expr("bit_xor(xxhash64(b, a, 7))")).first()

    e = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b"))
    was = None
    for _ in range(max_rounds):
        for _ in range(2):
            e = _stars(_stars(e, large=True), large=False)
        e = stored(e, name)
        now = state(e)
        if now == was or not now[0]:
            break
        was = now
    else:
        raise RuntimeError("components did not converge")
    roots = e.select(F.col("b").alias("id")).distinct()
    return (e.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(roots.select("id", F.col("id").alias("component"))))
