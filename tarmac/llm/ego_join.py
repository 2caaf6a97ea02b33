"""Near-duplicate vectors: epsilon grid order join within equal labels.

Vectors of one label link when their cosine, in double precision, is at least
``COSINE``. Scaled to length one that is a distance of at most
``EPSILON = sqrt(2 - 2 * COSINE)``, and a projection on orthonormal directions never
enlarges a distance.

1. Equal vectors of a label become one class with a number of copies.
2. Classes are projected on ``DIMENSIONS`` principal directions (found on a bounded
   sample; they steer only how much is skipped) and sorted in epsilon grid order: by
   label, then by the cells of side epsilon, first direction first. The order is cut into
   intervals of at most ``BLOCK`` vectors and these, ``SPREAD`` in a row, into longer ones.
3. Pairs of long intervals, then of intervals within them, are kept unless their boxes
   are provably more than epsilon apart. Long intervals of a label with more than ``FEW``
   of them meet only in the cells of the ``LEAD`` first directions that both boxes touch
   or border on, so a hot label is neither all pairs of its intervals nor one task. Each
   kept pair is one row, with both intervals' vectors.
4. In a task the pair is halved recursively, skipping distant halves, down to ``LEAF``
   vectors, whose cosines are a matrix product. Cosines within ``TIE`` of the threshold
   are decided by exactly rounded sums.
5. A pair row yields counts of links and, per vector, one edge to the smallest class of
   its component inside the pair: components follow from these without all links.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
null labels and null ids link with nothing (their component is their own id). Vectors of
different lengths don't link. Repeated vec_ids are separate rows with one node; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import components, stored

COSINE = 0.98
EPSILON = math.sqrt(2 - 2 * COSINE)
DIMENSIONS = 6
SAMPLE = 4096                 # vectors the principal directions are fitted on
BLOCK, SPREAD, LEAF = 256, 32, 64
FEW, LEAD = 64, 3
CELL = EPSILON * (1 + 1e-6)   # boxes that may hold a link are at most one cell apart
TIE = 1e-12
NEAR = EPSILON ** 2 * (1 + 1e-9)


# ── classes ───────────────────────────────────────────────────────────


def prepared(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, label, dim, cls, vec): cls is null where the row can't link."""
    def read(batches):
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cls, dim, vec = [], [], []
            for vid, label, v in zip(ids, labels, batch.column(2)):
                raw = None
                if v.is_valid and v.values.null_count == 0 and vid is not None and label is not None:
                    x = v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0    # -0.0 is 0.0
                    if len(x) and np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                if raw is None:
                    cls.append(None)
                    dim.append(None)
                else:
                    h = xxhash.xxh64_intdigest(raw, label & 0xFFFFFFFF)
                    cls.append(h - (1 << 64) if h >> 63 else h)
                    dim.append(len(raw) // 8)
                vec.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dim, pa.int32()), pa.array(cls, pa.int64()),
                 pa.array(vec, pa.binary())], ["vec_id", "label", "dim", "cls", "vec"])

    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                           F.col("label").cast("long").alias("label"), F.col(column).alias("vec"))
            .mapInArrow(read, "vec_id long, label long, dim int, cls long, vec binary"))


def directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Principal directions for each vector length of a sample of at most ``SAMPLE`` classes."""
    sample = (rows.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("dim", "vec").collect())
    out = {}
    for dim in sorted({r["dim"] for r in sample}):
        x = np.stack([np.frombuffer(r["vec"], "<f8") for r in sample if r["dim"] == dim])
        x = unit(x)
        x = x - x.mean(axis=0)
        _, v = np.linalg.eigh(x.T @ x)
        out[dim] = v[:, ::-1][:, :DIMENSIONS]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow or underflow in squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def project(x: np.ndarray, known: dict[int, np.ndarray]) -> np.ndarray:
    dim = x.shape[1]
    axes = known.get(dim)
    p = unit(x) @ axes if axes is not None else unit(x)[:, :DIMENSIONS]
    return np.pad(p, ((0, 0), (0, DIMENSIONS - p.shape[1])))


def intervals(classes: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """Sequence intervals of the epsilon grid order:
    (block, long, label, dim, lo, hi, ids, copies, vecs)."""
    shared = classes.sparkSession.sparkContext.broadcast(known)
    cells = [f"c{k}" for k in range(DIMENSIONS)]

    def place(batches):
        for batch in batches:
            dim = batch.column(2).to_numpy()
            vecs = batch.column(4).to_pylist()
            grid = np.zeros((len(dim), DIMENSIONS))
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                x = np.frombuffer(b"".join(vecs[k] for k in at), "<f8").reshape(len(at), d)
                grid[at] = project(x, shared.value)
            grid = np.floor(grid / EPSILON).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(grid[:, k].copy()) for k in range(DIMENSIONS))],
                [*batch.schema.names, *cells])

    rows = classes.select("cls", "label", "dim", "copies", "vec").mapInArrow(
        place, "cls long, label long, dim int, copies long, vec binary, "
               + ", ".join(f"{c} int" for c in cells))
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.repartitionByRange(n, "label", "dim", *cells, "cls")
            .sortWithinPartitions("label", "dim", *cells, "cls")
            .select("cls", "label", "dim", "copies", "vec"))

    def cut(batches):
        part = TaskContext.get().partitionId()
        seq = 0
        held: list = []

        def emit(rows):
            nonlocal seq
            dim = rows[0][2]
            raw = b"".join(r[4] for r in rows)
            p = project(np.frombuffer(raw, "<f8").reshape(len(rows), dim), shared.value)
            out = (part * (1 << 32) + seq, part * (1 << 32) + seq // SPREAD, rows[0][1], dim,
                   p.min(axis=0).tolist(), p.max(axis=0).tolist(), [r[0] for r in rows],
                   [r[3] for r in rows], raw)
            seq += 1
            return out

        schema = pa.schema([("block", pa.int64()), ("long", pa.int64()), ("label", pa.int64()),
                            ("dim", pa.int32()), ("lo", pa.list_(pa.float64())),
                            ("hi", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())),
                            ("copies", pa.list_(pa.int64())), ("vecs", pa.binary())])

        def rows_of(batch):
            return zip(*(batch.column(k).to_pylist() for k in range(5)))

        def pack(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in batches:
            out = []
            for r in rows_of(batch):
                if held and (len(held) == BLOCK or held[0][1:3] != r[1:3]):
                    out.append(emit(held))
                    held = []
                held.append(r)
            if out:
                yield pack(out)
        if held:
            yield pack([emit(held)])

    return rows.mapInArrow(cut, "block long, long long, label long, dim int, lo array<double>, "
                                "hi array<double>, ids array<long>, copies array<long>, vecs binary")


# ── interval pairs ────────────────────────────────────────────────────


def _gap(a: str, b: str):
    """Squared distance of two boxes, at least."""
    return F.expr(" + ".join(
        f"pow(greatest(0D, {b}.lo[{k}] - {a}.hi[{k}], {a}.lo[{k}] - {b}.hi[{k}]), 2)"
        for k in range(DIMENSIONS)))


def _in_cells(wide: DataFrame, reach: int) -> DataFrame:
    """A row for each cell of the leading directions that a long interval's box touches, or
    that lies within ``reach`` of one; ``from_k`` is the first. One row where they are few."""
    many = F.col("together") > FEW
    for k in range(LEAD):
        first = F.floor(F.col("lo")[k] / CELL) - reach
        last = F.floor(F.col("hi")[k] / CELL) + reach
        cells = F.when(many, F.sequence(first, last)).otherwise(F.array(F.lit(0).cast("long")))
        wide = (wide.withColumn(f"from_{k}", F.when(many, first).otherwise(F.lit(0)))
                .withColumn(f"cell_{k}", F.explode(cells)))
    return wide


def long_pairs(box: DataFrame) -> DataFrame:
    """(label, dim, long_a, long_b) of long intervals, a <= b, whose boxes are near."""
    wide = box.groupBy("label", "dim", "long").agg(
        F.array(*(F.min(F.col("lo")[k]) for k in range(DIMENSIONS))).alias("lo"),
        F.array(*(F.max(F.col("hi")[k]) for k in range(DIMENSIONS))).alias("hi"))
    wide = wide.join(wide.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("together")), ["label", "dim"])
    x, y = _in_cells(wide, 1).alias("x"), _in_cells(wide, 0).alias("y")
    meet = ["x.label = y.label", "x.dim = y.dim", "x.long <= y.long",
            *(f"x.cell_{k} = y.cell_{k}" for k in range(LEAD))]
    # a pair counts in the first of the cells that it shares
    once = [f"x.cell_{k} = greatest(x.from_{k}, y.from_{k})" for k in range(LEAD)]
    return (x.join(y, F.expr(" and ".join(meet + once))).where(_gap("x", "y") <= NEAR)
            .select(F.col("x.label").alias("label"), F.col("x.dim").alias("dim"),
                    F.col("x.long").alias("long_a"), F.col("y.long").alias("long_b")))


def interval_pairs(blocks: DataFrame) -> DataFrame:
    """(a, b) of intervals with a <= b that may hold a link."""
    box = blocks.select("block", "long", "label", "dim", "lo", "hi")
    a, b = box.alias("a"), box.alias("b")
    r = long_pairs(box).alias("r")
    return (r.join(a, F.expr("r.label = a.label and r.dim = a.dim and r.long_a = a.long"))
            .join(b, F.expr("r.label = b.label and r.dim = b.dim and r.long_b = b.long"))
            .where("a.block <= b.block").where(_gap("a", "b") <= NEAR)
            .select(F.col("a.block").alias("a"), F.col("b.block").alias("b")))


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    norm = math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
    return math.fsum(x * y) / norm


def linked(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray) -> np.ndarray:
    """Boolean matrix of links between unit vectors, by recursive halving; ``px`` and ``py``
    are their projections."""
    out = np.zeros((len(x), len(y)), bool)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        gap = np.maximum(0, np.maximum(py[c:d].min(axis=0) - px[a:b].max(axis=0),
                                       px[a:b].min(axis=0) - py[c:d].max(axis=0)))
        if (gap * gap).sum() > NEAR:
            continue
        if max(b - a, d - c) > LEAF:
            if b - a >= d - c:
                m = (a + b) // 2
                todo += [(a, m, c, d), (m, b, c, d)]
            else:
                m = (c + d) // 2
                todo += [(a, b, c, m), (a, b, m, d)]
            continue
        cosine = x[a:b] @ y[c:d].T
        out[a:b, c:d] = cosine >= COSINE
        for i, j in zip(*np.nonzero(np.abs(cosine - COSINE) <= TIE)):
            out[a + i, c + j] = exact_cosine(x[a + i], y[c + j]) >= COSINE
    return out


def local_components(link: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Smallest class that each class reaches inside one pair of intervals."""
    low_l, low_r = left.copy(), right.copy()
    most = np.iinfo(np.int64).max
    while True:
        new_r = np.minimum(low_r, np.where(link, low_l[:, None], most).min(axis=0))
        new_l = np.minimum(low_l, np.where(link, new_r[None, :], most).min(axis=1))
        if (new_l == low_l).all() and (new_r == low_r).all():
            return low_l, low_r
        low_l, low_r = new_l, new_r


def pair_links(blocks: DataFrame, pairs: DataFrame, known: dict[int, np.ndarray]) -> DataFrame:
    """(cls, links, low) over all interval pairs."""
    shared = blocks.sparkSession.sparkContext.broadcast(known)
    data = ["ids", "copies", "vecs"]
    a = blocks.select(F.col("block").alias("a"), "dim", *(F.col(c).alias(f"{c}_a") for c in data))
    b = blocks.select(F.col("block").alias("b"), *(F.col(c).alias(f"{c}_b") for c in data))
    rows = (pairs.join(a, "a").join(b, "b")
            .select("a", "b", "dim", *(f"{c}_a" for c in data), *(f"{c}_b" for c in data)))

    def join(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids_a, ids_b = np.array(r["ids_a"], np.int64), np.array(r["ids_b"], np.int64)
                x = np.frombuffer(r["vecs_a"], "<f8").reshape(len(ids_a), r["dim"])
                y = np.frombuffer(r["vecs_b"], "<f8").reshape(len(ids_b), r["dim"])
                link = linked(unit(x), unit(y), project(x, shared.value), project(y, shared.value))
                if r["a"] == r["b"]:
                    np.fill_diagonal(link, False)
                    link |= link.T
                    counts = [(ids_a, link @ np.array(r["copies_b"]))]
                else:
                    counts = [(ids_a, link @ np.array(r["copies_b"])),
                              (ids_b, np.array(r["copies_a"]) @ link)]
                if not link.any():
                    continue
                lows = local_components(link, ids_a, ids_b)
                for (ids, n), low in zip(counts, lows):
                    ok = n > 0
                    if ok.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[ok]), pa.array(n[ok].astype(np.int64)), pa.array(low[ok])],
                            ["cls", "links", "low"])

    return rows.mapInArrow(join, "cls long, links long, low long")


def link_report(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    rows = stored(prepared(vectors, column), "ego-rows")
    able = rows.where("cls is not null")
    copies = able.groupBy("label", "dim", "cls").agg(F.count(F.lit(1)).alias("copies"))
    one = able.dropDuplicates(["label", "dim", "cls"]).select("label", "dim", "cls", "vec")
    classes = one.join(copies, ["label", "dim", "cls"])
    known = directions(one)
    blocks = stored(intervals(classes, known), "ego-blocks")
    found = stored(pair_links(blocks, interval_pairs(blocks), known), "ego-links")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    comp = components(found.where("low <> cls").select(F.col("cls").alias("a"), F.col("low").alias("b")),
                      "ego-cc")
    node = (copies.select("cls", "copies").join(links, "cls", "left")
            .join(comp.select(F.col("id").alias("cls"), "component"), "cls", "left")
            .select("cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.coalesce("component", "cls").alias("component")))
    out = rows.select("vec_id", "cls").join(node, "cls", "left")
    low = (out.where("component is not null").groupBy("component")
           .agg(F.min("vec_id").alias("component_id")))
    out = out.join(low, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
