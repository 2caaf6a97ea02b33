"""Vector compression: codes of consecutive parts by exact integer ball k-means.

A vector's components x become integers ``floor(1024 * x)`` and it is cut into ``PARTS``
equal consecutive parts (zeros fill a length that doesn't divide). Every part position has
a codebook of up to ``ENTRIES`` entries that starts as that part of the first kept vectors
by vec_id. Each of ``ROUNDS`` rounds gives every part to its nearest entry (squared
Euclidean distance, ties to the lower index) and puts every used entry at the componentwise
``floor(sum / count)`` of its parts. A last pass gives the codes and errors.

An entry and its parts form a ball. Within the parts at hand (a chunk of a task; for any
subset the bounds hold as they do for all):

* an entry c can only take a part from the ball of b if ``|b - c| <= 2 r`` with r the
  ball's radius, the distance of its farthest part: b's neighbours. Distances between
  entries are known once per round and sorted;
* a part at distance e from b with ``2 e < |b - c|`` for the nearest neighbour c lies in
  the stable core: it stays, nothing is computed;
* the others lie in rings between the halved distances to successive neighbours: a part is
  compared only with the neighbours c of ``|b - c| <= 2 e``. A ball's parts are sorted by e
  and compared a ring at a time.

All comparisons are between squared integers, so the result equals a full search, ties
too. The first round, which has no balls, compares all entries.

Spark deals the rows: each round reads the table of the round before, writes vectors and
codes, and sums the parts per (part, entry) inside the tasks, then by Spark. Codebooks
(``PARTS * ENTRIES`` entries, whatever the data) go to every task; nothing else does. A
round's table is deleted when the next one is complete.

Defined cases: rows whose vector is null, empty or holds null or non-finite components, or
has another length than the first kept vector, are dropped. Null vec_ids come after all
ids; rows of one vec_id are put in the order of their vectors and all kept. Integers are
held within ``+-2^28``, so that sums of squares stay exact. An empty table has no row. With
fewer than ``ENTRIES`` vectors there are as many entries. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import rows_with_ids, sliding_runs, stored, stored_at, without_table

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
LIMIT = 1 << 28
ROWS = 1 << 15                # vectors a task holds at a time
RING = 64                     # parts of a ball compared at a time

ROW = "vec_id long, label long, ints array<bigint>"


# ── vectors ───────────────────────────────────────────────────────────


def integers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, ints) of the rows whose vector is whole and finite."""
    def read(batches):
        for batch in batches:
            col = batch.column(2)
            off = col.offsets.to_numpy()
            x = col.values.to_numpy(zero_copy_only=False).astype(np.float64)       # null: nan
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(x))))
            ok = col.is_valid().to_numpy(zero_copy_only=False) & (np.diff(off) > 0) & (bad[off[1:]] == bad[off[:-1]])
            whole = np.clip(np.floor(np.where(np.isfinite(x), x, 0) * SCALE), -LIMIT, LIMIT).astype(np.int64)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(off), pa.array(whole))],
                ["vec_id", "label", "ints"])
            yield out.filter(pa.array(ok))

    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col(column).alias("vec")).mapInArrow(read, ROW))


def grids(batches) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows ``ROWS`` at a time, and their vectors as a matrix."""
    held: list[pa.RecordBatch] = []
    n = 0

    def matrix():
        t = pa.Table.from_batches(held).combine_chunks()
        ints = t.column("ints").combine_chunks()
        if isinstance(ints, pa.ChunkedArray):
            ints = ints.chunk(0)
        return t, ints.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= ROWS:
            yield matrix()
            held, n = [], 0
    if held:
        yield matrix()


def split_parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """The columns of a matrix in equal consecutive parts, zeros filling the last."""
    width = -(-x.shape[1] // parts)
    full = np.zeros((len(x), width * parts), np.int64)
    full[:, : x.shape[1]] = x
    return [full[:, k * width: (k + 1) * width] for k in range(parts)]


# ── nearest entries ───────────────────────────────────────────────────


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x to all rows of y: a matrix product in doubles
    where every sum stays below 2^53, else in integers."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)), 1)
    if 4 * top * top * max(x.shape[1], 1) < 1 << 53:
        a, b = x.astype(np.float64), y.astype(np.float64)
        d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        return d.astype(np.int64)
    d = np.zeros((len(x), len(y)), np.int64)
    for k in range(x.shape[1]):
        d += (x[:, k, None] - y[None, :, k]) ** 2
    return d


def nearest_of_all(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each row."""
    code, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for s in range(0, len(x), 4096):
        d = squares(x[s: s + 4096], entries)
        best = d.argmin(axis=1)
        code[s: s + 4096], error[s: s + 4096] = best, d[np.arange(len(d)), best]
    return code, error


def nearest_by_balls(x: np.ndarray, entries: np.ndarray, gaps: np.ndarray,
                     before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest_of_all``, given the entry of each row in the round before and the squared
    distances between entries (``gaps``)."""
    code = before.copy()
    error = ((x - entries[before]) ** 2).sum(axis=1)
    order = np.lexsort((error, before))              # ball by ball, from its centre outwards
    at = sliding_runs(before[order])
    for a, b in zip(at, np.append(at[1:], len(order))):
        ball = int(before[order[a]])
        rows = order[a:b]
        near = np.argsort(gaps[ball], kind="stable")
        rings = gaps[ball][near]
        first = np.flatnonzero(near != ball)
        if not len(first):
            continue
        out = int(np.searchsorted(4 * error[rows], rings[first[0]], "left"))    # behind the stable core
        for s in range(out, len(rows), RING):
            ring = rows[s: s + RING]
            reach = 4 * error[ring]
            some = np.sort(near[: int(np.searchsorted(rings, reach[-1], "right"))])
            d = squares(x[ring], entries[some])
            best = d.argmin(axis=1)                  # the lowest index of equals
            code[ring], error[ring] = some[best], d[np.arange(len(d)), best]
    return code, error


# ── rounds ────────────────────────────────────────────────────────────


def assigned(rows: DataFrame, books: list[np.ndarray], last: bool = False) -> DataFrame:
    """Every vector with its codes (and, in the ``last`` pass, the sum of its squared distances
    instead of its integers). ``rows`` has ``codes`` but in the first round."""
    parts = len(books)
    known = "codes" in rows.columns

    def assign(batches):
        gaps = [squares(e, e) for e in books]
        for t, x in grids(batches):
            old = (t.column("codes").combine_chunks().flatten().to_numpy().reshape(len(t), parts)
                   if known else None)
            codes = np.empty((len(t), parts), np.int64)
            error = np.zeros(len(t), np.int64)
            for k, part in enumerate(split_parts(x, parts)):
                codes[:, k], e = (nearest_by_balls(part, books[k], gaps[k], old[:, k].astype(np.int64)) if known
                                  else nearest_of_all(part, books[k]))
                error += e
            off = pa.array(np.arange(0, codes.size + 1, parts, dtype=np.int32))
            flat = pa.ListArray.from_arrays(off, pa.array(codes.ravel().astype(np.int32)))
            cols = [t.column("vec_id"), t.column("label")]
            cols += [pa.array(error)] if last else [t.column("ints")]
            out = pa.Table.from_arrays([*cols, flat], ["vec_id", "label", "error" if last else "ints", "codes"])
            yield from out.to_batches()

    kind = "error long" if last else "ints array<bigint>"
    return rows.mapInArrow(assign, f"vec_id long, label long, {kind}, codes array<int>")


def sums(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """(part, entry, at, total): componentwise sums of the parts of every entry; ``at`` = -1
    counts them. A task sends one row per component of the entries it met."""
    parts = len(sizes)

    def add(batches):
        total = None
        for t, x in grids(batches):
            codes = t.column("codes").combine_chunks().flatten().to_numpy().reshape(len(t), parts)
            cut = split_parts(x, parts)
            if total is None:
                total = [np.zeros((n, cut[0].shape[1] + 1), np.int64) for n in sizes]
            for k, part in enumerate(cut):
                order = np.argsort(codes[:, k], kind="stable")
                at = sliding_runs(codes[order, k])
                used = codes[order[at], k]
                total[k][used, 1:] += np.add.reduceat(part[order], at, axis=0)
                total[k][used, 0] += np.diff(np.append(at, len(order)))
        for k, m in enumerate(total or ()):
            used = np.flatnonzero(m[:, 0])
            width = m.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used) * width, k)), pa.array(np.repeat(used, width)),
                 pa.array(np.tile(np.arange(-1, width - 1), len(used))), pa.array(m[used].ravel())],
                ["part", "entry", "at", "total"])

    return (rows.mapInArrow(add, "part long, entry long, at long, total long")
            .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")))


def moved(books: list[np.ndarray], found) -> list[np.ndarray]:
    """Codebooks with every used entry at the floored mean of its parts."""
    counts = {(r["part"], r["entry"]): r["total"] for r in found if r["at"] < 0}
    new = [e.copy() for e in books]
    for r in found:
        if r["at"] >= 0:
            new[r["part"]][r["entry"], r["at"]] = r["total"] // counts[r["part"], r["entry"]]
    return new


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for e in books for v in e.ravel().tolist()).encode()).hexdigest()


def compressed(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, error, codes) of every kept vector, and the final codebooks."""
    rows = stored(integers(vectors, column), "codes-ints")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    if not first:
        return rows.select("vec_id", "label", F.lit(0).cast("long").alias("error"),
                           F.array().cast("array<int>").alias("codes")), []
    dim = len(first[0]["ints"])
    if any(len(r["ints"]) != dim for r in first):
        first = (rows.where(F.size("ints") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "ints")
                 .limit(entries).collect())
    books = split_parts(np.array([r["ints"] for r in first], np.int64), parts)
    rows = rows.where(F.size("ints") == dim)
    path = None
    for _ in range(rounds):
        now, there = stored_at(assigned(rows, books), "codes-round")
        books = moved(books, sums(now, [len(e) for e in books]).collect())
        if path:
            without_table(now.sparkSession, path)
        rows, path = now, there
    return assigned(rows, books, last=True), books


def code_report(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector."""
    found, books = compressed(vectors)
    found = stored(found, "codes-final")
    by_label = found.groupBy(F.coalesce("label", F.lit(0)).alias("l"), F.col("label").isNull().alias("none")).agg(
        F.sum("error").alias("label_error"))
    keyed = found.withColumn("l", F.coalesce("label", F.lit(0))).withColumn("none", F.col("label").isNull())
    hexed = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return (rows_with_ids(keyed, by_label, ["l", "none"])
            .select("vec_id", hexed.alias("code"), "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
