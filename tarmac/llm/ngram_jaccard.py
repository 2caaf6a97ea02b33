"""Exact Jaccard links between documents' word-shingle sets (count-vector R-tree).

A document's set is its distinct five-word shingles after A-Z are lower-cased
(fewer words: the whole sequence is the one shingle; no words: empty set, linked
with nothing). Two documents link when ``100 * |A & B| >= 75 * |A | B|``;
``component_id`` is the smallest doc_id reachable by links.

How the work is dealt out:

1. Documents with equal sets form a class (a 64-bit fingerprint of set and size),
   and only one document of a class goes on, so copies cost one row each.
2. Sets of sizes n and m that link share ``k`` of the first ``n // 4 + k`` and
   ``m // 4 + k`` shingles in any common order; here ``k = 1 + min(n, m) // 32``. Frequent
   shingles (found in one pass over everything) come last in the order, the rest by
   hash. Each such leading shingle is one row. Shingles that only one class leads with
   go at once, and so do classes that share too few with all others together.
3. Families: of the classes that lead with a shingle, the one that shares most is the
   center; each class joins the family of the center it shares most leading shingles with.
   A family is compared whole in a task (a large one in pairs of chunks) by a count-vector
   R-tree: shingles are hashed into ``GROUPS`` groups, a set is the point of its group
   counts, and ``sum_g min(a_g, b_g)`` bounds the overlap of two points or of two boxes (a
   box by its largest counts and smallest size). Surviving pairs are verified on the sets
   unless links found so far connect them, so a group of copies costs few verifications
   and gives no more links than it has members.
4. Pairs of different families: shingle groups that still hold two components are joined
   by the same R-tree (a group of at most ``LEAF`` classes is one leaf), leaving out pairs
   of one component or family. Those that share ``k`` leading shingles meet the bound over
   finer points, of as many groups as the set has shingles (halving the groups of a point
   adds neighbours, so points of two resolutions compare), and then their sets.

Defined cases: null text counts as empty. Rows with a null doc_id get their shingle
count, but no links (component_id is null). Repeated doc_ids are separate rows; the
id stands for both in a component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import (SpanHash, byte_codes, components, mix64, rows_with_ids, sliding_runs,
                               stored, utf8_chunks, word_spans)

SHINGLE_WORDS = 5
GROUPS = 64                   # coordinates of a count vector in the tree
FINEST = 1 << 16              # most coordinates of a fine count vector
LEAF, FANOUT = 8, 16          # points of an R-tree leaf, children of a node
SEGMENT = 2048                # points of one tree; a larger block is a row of trees by size
ROWS_OUT = 1000               # documents in one Arrow batch of a task's output
CHUNK = 400                   # members of a family compared in one group of rows
MAX_FREQUENT = 1 << 18        # frequent shingles kept for the order (2 MB to each task)
MORE = 32                     # a set of n leads with n // MORE shingles more than one common one needs
FLUSH, FLUSH_LEAST, FREQUENT_LEAST = 1 << 21, 4, 64
STEP = np.uint64(0xD6E8FEB86659FD93)


def links(a: int, b: int, both: int) -> bool:
    """Sizes of two sets and of their intersection: do they link?"""
    return 100 * both >= 75 * (a + b - both)


# ── shingles of a batch ───────────────────────────────────────────────


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, in order."""
    codes = byte_codes(fold_case=True)
    for i, j, buf, offs in utf8_chunks(texts):
        starts, ends, first = word_spans(buf, offs)
        word = SpanHash(buf, codes)(starts, ends) if len(starts) else np.zeros(0, np.uint64)
        m = max(len(word) - SHINGLE_WORDS + 1, 0)
        whole = np.zeros(m, np.uint64)
        for k in range(SHINGLE_WORDS):
            whole = (whole ^ word[k: k + m]) * STEP
            whole ^= whole >> np.uint64(29)
        whole = mix64(whole)
        for d in range(j - i):
            a, b = int(first[d]), int(first[d + 1])
            if b - a >= SHINGLE_WORDS:
                h = np.sort(whole[a: b - SHINGLE_WORDS + 1])
                yield h[sliding_runs(h)]
            elif b > a:
                h = np.full(1, b - a, np.uint64)      # the length keeps short texts apart
                for k in range(a, b):
                    h = (h ^ word[k]) * STEP
                    h ^= h >> np.uint64(29)
                yield mix64(h)
            else:
                yield np.zeros(0, np.uint64)


def class_id(tokens: np.ndarray) -> int:
    if not len(tokens):
        return 0
    h = np.array([len(tokens)], np.uint64) + np.bitwise_xor.reduce(mix64(tokens ^ STEP))
    return int(mix64(h * STEP + np.add.reduce(tokens)).view(np.int64)[0])


def resolution(n: int) -> int:
    """Coordinates of the fine point of a set of ``n``: a power of two, at most one shingle
    per coordinate on average (up to ``FINEST``)."""
    return min(max(GROUPS, 1 << max(n - 1, 0).bit_length()), FINEST)


def fine_point(tokens: np.ndarray) -> bytes:
    """Counts of the shingles by their leading bits: a byte each, or four if one needs them."""
    g = resolution(len(tokens))
    count = np.bincount((tokens >> np.uint64(65 - g.bit_length())).astype(np.int64), minlength=g)
    return count.astype("u1" if count.max() < 256 else "<i4").tobytes()


def unpack_point(point: bytes, n: int) -> np.ndarray:
    return np.frombuffer(point, "u1" if len(point) == resolution(n) else "<i4").astype(np.int32)


def coarse_point(point: bytes, n: int) -> bytes:
    """The same counts in ``GROUPS`` coordinates."""
    count = folded(unpack_point(point, n), GROUPS)
    return count.astype("u1" if count.max() < 256 else "<i4").tobytes()


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    return point.reshape(groups, -1).sum(axis=1, dtype=np.int32)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    g = min(len(a), len(b))
    return int(np.minimum(folded(a, g), folded(b, g)).sum())


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """The most frequent shingles, at most ``MAX_FREQUENT``: only the order depends on them."""
    def count(batches):
        held: list[np.ndarray] = []
        size = 0

        def flush():
            if not held:
                return None
            h = np.sort(np.concatenate(held))
            at = sliding_runs(h)
            n = np.diff(np.append(at, len(h)))
            keep = n >= FLUSH_LEAST
            return pa.RecordBatch.from_arrays(
                [pa.array(h[at][keep].view(np.int64)), pa.array(n[keep])], ["token", "n"])

        for batch in batches:
            for tokens in shingle_sets(batch.column(0)):
                held.append(tokens)
                size += len(tokens)
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        last = flush()
        if last is not None:
            yield last

    top = (docs.select("text").mapInArrow(count, "token long, n long")
           .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT_LEAST)
           .orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token").toPandas())
    return np.sort(top["token"].to_numpy(np.int64).view(np.uint64))


def signatures(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Per document: hash of the text, class, set size and, for the first of a class in a task, point and prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = pa.schema([("doc_id", pa.int64()), ("tid", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()),
                        ("point", pa.binary()), ("coarse", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def sign(batches):
        often = shared.value
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(at, ROWS_OUT)
                ids = part.column(0)
                rows = []
                for doc_id, tokens in zip(ids.is_valid().to_pylist(), shingle_sets(part.column(1))):
                    c, n = class_id(tokens), len(tokens)
                    if not n or not doc_id or c in seen:
                        rows.append((c, n, None, None, None))
                        continue
                    seen.add(c)
                    in_order = tokens
                    if len(often):
                        k = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
                        last = often[k] == tokens
                        in_order = np.concatenate((tokens[~last], tokens[last]))
                    point = fine_point(tokens)
                    rows.append((c, n, point, coarse_point(point, n),
                                 in_order[: n // 4 + 1 + n // MORE].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [ids, part.column(2), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[2:]))],
                    schema=schema)

    return docs.select("doc_id", "text", F.xxhash64("text").alias("tid")).mapInArrow(
        sign, "doc_id long, tid long, cls long, n long, point binary, coarse binary, prefix array<long>")


# ── shared leading shingles ───────────────────────────────────────────


def grouped(rows: DataFrame, *order) -> DataFrame:
    """(token, cls, n, center, center_n) of shingles that two classes of ``rows(token, cls, n)``
    or more lead with; center is the first class of the group in the given order, in which
    equal rows follow each other. Groups are read as a sorted stream, so a hot one needs no
    memory."""
    rows = (rows.repartition("token").sortWithinPartitions("token", *order)
            .select("token", "cls", "n"))

    def group(batches):
        head = None                  # (token, cls, n, told) of the group that is open
        last = None
        for batch in batches:
            token, cls, n = (batch.column(k).to_numpy() for k in range(3))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            if last is not None and len(token):
                new[0] = (token[0], cls[0]) != last
            if len(token):
                last = (token[-1], cls[-1])
            token, cls, n = token[new], cls[new], n[new]
            if not len(token):
                continue
            told = False
            if head is not None and head[0] == token[0]:
                token, cls, n = (np.concatenate(([h], x)) for h, x in zip(head[:3], (token, cls, n)))
                told = head[3]
            at = sliding_runs(token)
            size = np.diff(np.append(at, len(token)))
            which = np.repeat(np.arange(len(at)), size)
            keep = size[which] > 1
            if told:
                keep[0] = False
            k = at[-1]
            head = (token[k], cls[k], n[k], bool(size[-1] > 1) or (told and len(at) == 1))
            if keep.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[keep]) for x in (token, cls, n.astype(np.int32),
                                                 cls[at][which], n[at][which].astype(np.int32))],
                    ["token", "cls", "n", "center", "center_n"])

    return rows.mapInArrow(group, "token long, cls long, n int, center long, center_n int")


def shared_prefixes(signed: DataFrame) -> DataFrame:
    """``grouped`` leading shingles of the classes that share enough of them to link at all."""
    rows = (signed.where("prefix is not null")
            .select("cls", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("token")))
    led = stored(grouped(rows, "cls").select("token", "cls", "n"), "jaccard-led")
    able = (led.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("w"))
            .where(f"w >= 1 + (3L * n div 4) div {MORE}").select("cls", "w"))
    return grouped(led.join(able, "cls"), F.desc("w"), "cls")


# ── R-tree over count vectors ─────────────────────────────────────────


class CountTree:
    """Packed R-tree of count vectors. Level 0 holds points; each upper level holds, for
    ``FANOUT`` children, their largest counts and smallest size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((*points.T[:8], np.log2(np.maximum(sizes, 1)) * 8 // 1))
        self.order = order
        self.levels = [(points[order], sizes[order])]
        step = LEAF
        while len(self.levels[-1][1]) > 1:
            top, low = self.levels[-1]
            cut = np.arange(0, len(low), step)
            self.levels.append((np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut)))
            step = FANOUT

    def step(self, level: int) -> int:
        return LEAF if level == 1 else FANOUT

    def join(self, other: CountTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points (indices) whose overlap bound allows a link."""
        at, bt = len(self.levels) - 1, len(other.levels) - 1
        pairs = np.array([[0, 0]])
        while True:
            pairs = self._bounded(other, at, bt, pairs)
            if not len(pairs) or at == bt == 0:
                break
            if at >= bt:
                pairs = _descend(pairs, 0, self.step(at), len(self.levels[at - 1][1]))
                at -= 1
            else:
                pairs = _descend(pairs, 1, other.step(bt), len(other.levels[bt - 1][1]))
                bt -= 1
        if len(pairs):
            yield self.order[pairs[:, 0]], other.order[pairs[:, 1]]

    def _bounded(self, other, at, bt, pairs):
        top_a, low_a = self.levels[at]
        top_b, low_b = other.levels[bt]
        kept = []
        for k in range(0, len(pairs), 1 << 14):
            p = pairs[k: k + (1 << 14)]
            a, b = p[:, 0], p[:, 1]
            both = np.minimum(top_a[a], top_b[b]).sum(axis=1, dtype=np.int64)
            kept.append(p[175 * both >= 75 * (low_a[a] + low_b[b])])
        return np.concatenate(kept) if kept else pairs


def _descend(pairs: np.ndarray, side: int, step: int, n: int) -> np.ndarray:
    first = pairs[:, side] * step
    many = np.minimum(first + step, n) - first
    out = np.repeat(pairs, many, axis=0)
    out[:, side] = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return out


def block_pairs(cls, n, comp, family, points) -> Iterator[np.ndarray]:
    """Pairs of one block, sorted by size, in different components and families: rows
    (a, b, n_a, n_b), the smaller class first."""
    trees: list[tuple[CountTree, int]] = []                         # and the first row of each
    for k in range(0, len(n), SEGMENT):
        tree = CountTree(points[k: k + SEGMENT], n[k: k + SEGMENT])
        trees = [t for t in trees if 4 * n[min(t[1] + SEGMENT, len(n)) - 1] >= 3 * n[k]]
        trees.append((tree, k))
        for t, first in trees:
            for i, j in t.join(tree):
                i, j = i + first, j + k
                ok = (comp[i] != comp[j]) & (cls[i] < cls[j] if t is tree else cls[i] != cls[j])
                ok &= (family[i] != family[j]) & (family[i] != cls[j]) & (cls[i] != family[j])
                i, j = i[ok], j[ok]
                i, j = np.where(cls[i] < cls[j], i, j), np.where(cls[i] < cls[j], j, i)
                yield np.stack((cls[i], cls[j], n[i], n[j]), axis=1)


def tree_pairs(rows: DataFrame) -> DataFrame:
    """Candidate pairs ``(a, b, n_a, n_b, c)`` of rows ``(token, n, cls, comp, family,
    coarse)``, by block of a token; c counts common shingles, in parts."""
    def join(batches):
        held: list[pa.RecordBatch] = []

        def blocks(last: bool):
            t = pa.Table.from_batches(held)
            token = t.column(0).to_numpy()
            at = sliding_runs(token)
            ends = np.append(at[1:], len(token))
            done = len(at) if last else len(at) - 1
            n, cls, comp, family = (t.column(k).to_numpy() for k in (1, 2, 3, 4))
            points = np.stack([np.frombuffer(p, "u1" if len(p) == GROUPS else "<i4").astype(np.int32)
                               for p in t.column(5).to_pylist()])
            out = [p for a, b in zip(at[:done], ends[:done])
                   for p in block_pairs(cls[a:b], n[a:b].astype(np.int64), comp[a:b], family[a:b],
                                          points[a:b])]
            held.clear()
            if not last:
                held.extend(t.slice(int(at[-1])).to_batches())
            out = np.concatenate(out) if out else np.zeros((0, 4), np.int64)
            if len(out):
                order = np.lexsort((out[:, 1], out[:, 0]))
                out = out[order]
                new = np.ones(len(out), bool)
                new[1:] = (out[1:, :2] != out[:-1, :2]).any(axis=1)
                at = np.flatnonzero(new)
                cols = [*(out[at, k].copy() for k in range(4)), np.diff(np.append(at, len(out)))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["a", "b", "n_a", "n_b", "c"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if batch.column(0)[0] != batch.column(0)[-1] or held[0].column(0)[0] != batch.column(0)[0]:
                    yield from blocks(False)
        if held:
            yield from blocks(True)

    return (rows.select("token", "n", "cls", "comp", "family", "coarse")
            .repartition("token").sortWithinPartitions("token", "n", "cls")
            .mapInArrow(join, "a long, b long, n_a long, n_b long, c long"))


def leaf_pairs(rows: DataFrame) -> DataFrame:
    """The pairs of groups of at most ``LEAF`` classes that could link by size, are not
    connected yet and of different families."""
    names = ("cls", "n", "comp", "family")
    a = rows.select("token", *(F.col(c).alias(f"{c}_a") for c in names))
    b = rows.select("token", *(F.col(c).alias(f"{c}_b") for c in names))
    return (a.join(b, "token").where("cls_a < cls_b and comp_a <> comp_b and family_a <> family_b and "
                                     "family_a <> cls_b and cls_a <> family_b and "
                                     "4L * least(n_a, n_b) >= 3L * greatest(n_a, n_b)")
            .select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"),
                    F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"),
                    F.lit(1).cast("long").alias("c")))


def enough(pairs: DataFrame) -> DataFrame:
    """(a, b) of the pairs that have enough leading shingles in common."""
    return (pairs.groupBy("a", "b", "n_a", "n_b").agg(F.sum("c").alias("c"))
            .where(f"c >= 1 + least(n_a, n_b) div {MORE}").select("a", "b"))


def bounded(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs whose fine points ``points(cls, n, point)`` allow a link."""
    a = points.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("point").alias("p_a"))
    b = points.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("point").alias("p_b"))

    def keep(batches):
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(2, 6)]
            ok = [175 * overlap_bound(unpack_point(x, m), unpack_point(y, n)) >= 75 * (m + n)
                  for x, m, y, n in zip(*cols)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(ok, pa.bool_())) for k in (0, 1)], ["a", "b"])

    return (pairs.join(a, "a").join(b, "b").select("a", "b", "p_a", "n_a", "p_b", "n_b")
            .mapInArrow(keep, "a long, b long"))


# ── families ──────────────────────────────────────────────────────────


def family_links(cls, n, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between the members ``left`` and ``right`` (indices; equal arrays: among them) that
    connect all members which any links connect."""
    points = np.stack([folded(unpack_point(fine_point(t), len(t)), GROUPS) for t in sets])
    trees = [CountTree(points[x], n[x]) for x in (left, right)]
    root = list(range(len(cls)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in trees[0].join(trees[1]):
        i, j = left[i], right[j]
        ok = cls[i] != cls[j]
        if left is right:
            ok &= i < j
        i, j = i[ok], j[ok]
        order = np.argsort(np.abs(n[i] - n[j]) + np.minimum(i, j), kind="stable")   # likely links first
        for a, b in zip(i[order].tolist(), j[order].tolist()):
            x, y = find(a), find(b)
            if x == y:
                continue
            s, t = sets[a], sets[b]
            if len(s) > len(t):
                s, t = t, s
            both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
            if links(len(s), len(t), both):
                root[max(x, y)] = min(x, y)
                out.append((int(cls[a]), int(cls[b])))
    return out


def linked_families(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links inside the families ``members(family, cls)``."""
    size = members.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    rows = members.join(size, "family").withColumn(
        "chunk", F.pmod(F.xxhash64("cls", F.lit(5)), F.col("chunks")).cast("int"))
    # chunk k takes part in the pairs (k, k), (k, other); a family of one chunk in (0, 0)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = (rows.select("family", "cls", "chunk", other.alias("other"))
            .select("family", "cls", "chunk", F.least("chunk", "other").alias("i"),
                    F.greatest("chunk", "other").alias("j")))
    rows = (rows.join(sets, "cls").repartition("family", "i", "j")
            .sortWithinPartitions("family", "i", "j", "chunk", "n", "cls")
            .select("family", "i", "j", "chunk", "cls", "n", "tokens"))

    def join(batches):
        def compare(t: pa.Table):
            chunk, cls, n = (t.column(k).to_numpy() for k in (3, 4, 5))
            lists = t.column(6).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = pa.concat_arrays(lists.chunks)
            values, at = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            tokens = [values[a:b] for a, b in zip(at[:-1], at[1:])]
            i, j = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            left = np.flatnonzero(chunk == i)
            right = left if i == j else np.flatnonzero(chunk == j)
            if len(left) and len(right):
                found = family_links(cls, n.astype(np.int64), tokens, left, right)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1)
            if held:
                last = held[-1]
                new[0] = any(last.column(k)[-1].as_py() != int(key[0, k]) for k in range(3))
            begin = 0
            for at in np.flatnonzero(new).tolist():
                if at > begin:
                    held.append(batch.slice(begin, at - begin))
                if held:
                    yield from compare(pa.Table.from_batches(held))
                    held = []
                begin = at
            held.append(batch.slice(begin))
        if held:
            yield from compare(pa.Table.from_batches(held))

    return rows.mapInArrow(join, "a long, b long")


# ── verification ──────────────────────────────────────────────────────


def class_sets(docs: DataFrame, signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, n, tokens) of the given classes, computed anew from one document of each."""
    ids = (rows_with_ids(signed.where("doc_id is not null").select("cls", "doc_id"), classes, "cls")
           .groupBy("cls").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct())
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def sets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                rows = [(class_id(t), len(t), t.view(np.int64))
                        for t in shingle_sets(batch.column(0).slice(at, ROWS_OUT))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = (rows_with_ids(docs.select("doc_id", "text"), ids, "doc_id").select("text")
             .mapInArrow(sets, "cls long, n int, tokens array<long>"))
    return found.join(classes, "cls", "left_semi").dropDuplicates(["cls"])


def verified(pairs: DataFrame, docs: DataFrame, signed: DataFrame, points: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of classes that link, written down."""
    pairs = stored(bounded(pairs, points), "jaccard-pairs")
    classes = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = stored(class_sets(docs, signed, classes), "jaccard-sets")
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    b = sets.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    return stored(pairs.join(a, "a").join(b, "b").withColumn("both", both)
                  .where("100L * both >= 75L * (n_a + n_b - both)").select("a", "b"), "jaccard-links")


def families(led: DataFrame) -> DataFrame:
    """(cls, n, family, family_n): the center that each class shares most leading shingles with,
    and enough to link; classes without one are left out."""
    near = led.where("cls <> center and 4L * least(n, center_n) >= 3L * greatest(n, center_n)")
    return (near.groupBy("cls", "n", "center", "center_n").agg(F.count(F.lit(1)).alias("c"))
            .where(f"c >= 1 + least(n, center_n) div {MORE}")
            .groupBy("cls", "n").agg(F.max_by(F.struct("center", "center_n"), F.struct("c", "center")).alias("f"))
            .select("cls", "n", F.col("f.center").alias("family"), F.col("f.center_n").alias("family_n")))


def link_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs(doc_id, text)``."""
    return components_of_rows(docs).select("doc_id", "n_shingles", "component_id")


def components_of_rows(docs: DataFrame) -> DataFrame:
    """As ``link_components``, with the hash of the text and the number of the group."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(signatures(docs, frequent_shingles(docs)), "jaccard-signed")
    points = signed.where("point is not null").select("cls", "n", "point").dropDuplicates(["cls"])
    coarse = signed.where("point is not null").select("cls", "coarse").dropDuplicates(["cls"])
    led = stored(shared_prefixes(signed), "jaccard-groups")

    own = stored(families(led), "jaccard-families")
    size = own.groupBy("family").agg(F.count(F.lit(1)).alias("others"))
    sized = own.join(size, "family")
    pairs = bounded(sized.where("others = 1").select(F.col("family").alias("a"), F.col("cls").alias("b")), points)
    pairs = pairs.select(F.col("a").alias("family"), F.col("b").alias("cls"))
    rest = sized.where("others > 1").select("family", "cls")
    members = pairs.unionByName(rest)
    members = stored(members.unionByName(members.select("family", F.col("family").alias("cls"))).distinct(),
                     "jaccard-members")
    sets = stored(class_sets(docs, signed, members.select("cls").distinct()), "jaccard-sets")
    inside = stored(linked_families(members, sets), "jaccard-inside")
    comp = components(inside, "jaccard-cc")

    rows = led.select("token", "cls", "n").join(
        comp.select(F.col("id").alias("cls"), F.col("component").alias("comp")), "cls", "left").join(
        own.select("cls", "family"), "cls", "left")
    rows = rows.withColumns({"comp": F.coalesce("comp", "cls"), "family": F.coalesce("family", "cls")})
    mixed = (rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                       F.min("family").alias("f_lo"), F.max("family").alias("f_hi"),
                                       F.count(F.lit(1)).alias("size"))
             .where("lo <> hi and f_lo <> f_hi").select("token", "size"))
    rows = stored(rows.join(mixed, "token"), "jaccard-mixed")
    large = rows.where(F.col("size") > LEAF).join(coarse, "cls")
    pairs = leaf_pairs(rows.where(F.col("size") <= LEAF)).unionByName(tree_pairs(large))
    more = verified(enough(pairs), docs, signed, points)
    comp = components(inside.unionByName(more), "jaccard-cc")

    known = signed.select("doc_id", "tid", "cls", "n").join(
        comp.select(F.col("id").alias("cls"), "component"), "cls", "left")
    known = known.withColumn("component", F.coalesce("component", "cls"))
    lowest = (known.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id")))
    out = known.join(lowest, "component", "left")
    return out.select(
        "doc_id", "tid", "component", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(),
               F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
        .alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group of linked documents the one
    whose doc_id is smallest (of rows of the group with this id, the one whose text and row
    have the least hash). Documents without words link with nothing and stay (of equal texts
    with one id, one), as do rows without an id."""
    found = components_of_rows(docs.select("doc_id", "text"))
    group = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("tid"))
    keep = (found.where("doc_id = component_id").groupBy("doc_id", group.alias("group"), F.col("n_shingles") > 0)
            .agg(F.min("tid").alias("_tid")).select(F.col("doc_id").alias("_kept"), "_tid").distinct())
    rows = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").cast("long").alias("_kept"),
                       F.xxhash64("_row.text").alias("_tid"))
    kept = (rows.join(keep, ["_kept", "_tid"], "left_semi").groupBy("_kept", "_tid")
            .agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*"))
    return kept.unionByName(docs.where("doc_id is null"))
