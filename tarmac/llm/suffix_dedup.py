"""Removal of every byte covered by a 400-byte string that starts twice (deep-shallow suffix sort).

Texts are UTF-8 bytes (null: empty). A byte goes if some 400-byte string over it also
starts elsewhere, in the same document or another; strings never cross documents and
are judged on the input, so all copies of a repeated passage go.

Sorting the suffixes at all positions would ship hundreds of bytes per byte of text.
Instead a sparse set of suffixes is sorted, from which all 400-byte strings follow:

1. Every 400-byte string holds 201 spans of 200 bytes; the one with the least hash
   (the leftmost of equals) is its anchor. Equal strings have equal anchors at equal
   offsets, so only strings with equal anchor spans need comparing. About one position
   in a hundred is an anchor. One row each: span hash, hash of its context (up to 200
   bytes on either side), text id, place.
2. Rows are sorted by span and context. A context that occurs twice repeats as a
   whole. Spans with two different contexts go on, one row per context.
3. For these the context bytes are fetched, and per span the suffixes that start behind
   it are sorted deep-shallow: passes that split each tied range by its next eight
   bytes (multikey quicksort) to ``SHALLOW`` bytes, then a blind trie orders each
   range that is still tied. The reversed bytes before the span are sorted alike.
   With both orders and their common-prefix lengths, the string that starts ``a``
   bytes before an anchor repeats if another context is in the same run for ``a``
   bytes to the left and for ``200 - a`` bytes to the right: two class numbers per
   offset, no pairs.
4. The covered intervals of a text are united and cut out.

Whole copies of a text count as one text in all this; a text of 400 bytes or more that
two rows have goes entirely. Text ids are 64-bit hashes of the whole text; where different
texts share one (their lengths or a second, independent hash differ) the second is theirs.

The window is a parameter of up to 510 bytes; spans are half as long.

Defined cases: null and empty texts have n_bytes 0 and the hash of the empty string;
null or repeated doc_ids are rows of their own; other columns are kept or ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import SpanHash, byte_codes, mix64, rows_with_ids, sliding_runs, stored, utf8_chunks

WINDOW, SPAN = 400, 200
PASSAGE = 240                 # bytes; a passage of more than 50 words has more in all but rare cases
SIDE = WINDOW - SPAN          # bytes of context on either side of a span
SHALLOW = 32                  # bytes sorted by multikey passes before the blind tries
MEMBERS = 4096                # suffixes sorted at a time (more if one span has more)
HIGH = np.uint64(0xFFFFFFFF00000000)
LOW = np.uint64(0x00000000FFFFFFFF)


def text_id(text: bytes) -> int:
    """The same number as Spark's ``xxhash64`` of the string."""
    h = xxhash.xxh64_intdigest(text, 42)
    return h - (1 << 64) if h >> 63 else h


def first_hash(text: Column) -> Column:
    return F.xxhash64(text)


def identified(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``tid``, and (tid, n, n_bytes) of all texts of at least ``window`` bytes.
    ``docs`` has ``text`` (no null) and none of the columns named here."""
    second = F.xxhash64(F.lit("second"), F.col("text"))
    keyed = docs.withColumn("tid", first_hash(F.col("text")))
    lengths = stored(keyed.where(F.octet_length("text") >= window).withColumn("second", second)
                     .groupBy("tid").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).cast("long").alias("n_bytes"),
                                         F.min(F.octet_length("text")).cast("long").alias("least"),
                                         F.min("second").alias("low"), F.max("second").alias("high")), "suffix-lengths")
    differ = (F.col("low") != F.col("high")) | (F.col("least") != F.col("n_bytes"))
    shared = lengths.where(differ).select("tid", F.lit(True).alias("shared"))
    if shared.isEmpty():
        return keyed, lengths.select("tid", "n", "n_bytes")
    keyed = (rows_with_ids(keyed, shared, "tid", "left")
             .withColumn("tid", F.when(F.col("shared") & (F.octet_length("text") >= window), second)
                         .otherwise(F.col("tid"))).drop("shared"))
    lengths = stored(keyed.where(F.octet_length("text") >= window).groupBy("tid").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).cast("long").alias("n_bytes")), "suffix-lengths")
    return keyed, lengths


# ── anchors ───────────────────────────────────────────────────────────


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, from running minima within blocks."""
    n = len(values)
    blocks = -(-n // width)
    grid = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    grid[:n] = values
    grid = grid.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return np.minimum(back[:m], ahead[width - 1: width - 1 + m])


def halves(window: int) -> tuple[int, int]:
    """Lengths of a window's spans and of the context on either side of them."""
    if not 2 <= window <= 510:
        raise ValueError("a window has 2 to 510 bytes")
    return window // 2, window - window // 2


def chunk_anchors(buf: np.ndarray, offs: np.ndarray, codes: np.ndarray, window: int = WINDOW):
    """(document, span hash, context hash, start, left, right) of all anchors of a chunk."""
    span_size, side = halves(window)
    n = len(buf)
    docs = np.flatnonzero(np.diff(offs) >= window)
    if not len(docs):
        return None
    h = SpanHash(buf, codes)
    m = n - span_size + 1
    span = mix64((h.total[span_size:] - h.total[:-span_size]) * h.down[:m])
    least = sliding_min((span & HIGH) | np.arange(m, dtype=np.uint64), side + 1)
    at, owner = [], []
    for d in docs:
        a = (least[offs[d]: offs[d + 1] - window + 1] & LOW).astype(np.int64)
        a = a[sliding_runs(a)]
        at.append(a)
        owner.append(np.full(len(a), d))
    at, owner = np.concatenate(at), np.concatenate(owner)
    left = np.minimum(side, at - offs[owner])
    right = np.minimum(side, offs[owner + 1] - at - span_size)
    shape = (left * (side + 1) + right).astype(np.uint64)
    context = mix64(h(at - left, at + span_size + right) + mix64(shape + np.uint64(1)))
    return owner, span[at], context, at - offs[owner], left, right


def needed_covers(owner, start, left, right, twice, window: int = WINDOW) -> np.ndarray:
    """A mask of rows whose contexts cover, text by text, all that the ``twice`` contexts cover:
    a text that says one thing over and over has an anchor every few bytes."""
    span_size = halves(window)[0]
    keep = np.zeros(len(owner), bool)
    rows = np.flatnonzero(twice & (left + span_size + right >= window))
    at = sliding_runs(owner[rows])
    for a, b in zip(at, np.append(at[1:], len(rows))):
        lo = start[rows[a:b]] - left[rows[a:b]]                      # both rise with the place
        hi = start[rows[a:b]] + span_size + right[rows[a:b]]
        i, end = 0, -1
        while i < len(lo):
            j = max(int(np.searchsorted(lo, end, "right")) - 1, i)
            if lo[i] > end:
                j = i
            if hi[j] > end:
                keep[rows[a + j]] = True
                end = hi[j]
            i = j + 1
    return keep


def anchors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(span, context, tid, place, twice) of ``docs(text, tid)``; place packs start, left and right. A text that a task
    meets again is left out. Of equal contexts in one text (words or lines said again and
    again) one row stands for all, with ``twice`` set, as the others need no comparison: of
    these, rows under keys of their own, only as many are left as cover what all cover."""
    def find(batches):
        codes = byte_codes(fold_case=False)
        seen: set[int] = set()
        for batch in batches:
            for i, j, buf, offs in utf8_chunks(batch.column(0)):
                found = chunk_anchors(buf, offs, codes, window)
                if found is None:
                    continue
                owner, span, context, start, left, right = found
                tid = batch.column(1)[i:j].to_numpy()
                new = np.zeros(j - i, bool)
                for d in np.unique(owner):
                    t = int(tid[d])
                    new[d] = t not in seen
                    seen.add(t)
                ok = new[owner]
                place = (start << 16) | (left << 8) | right
                order = np.lexsort((place, context, span, owner))
                same = np.zeros(len(order), bool)
                same[1:] = ((owner[order][1:] == owner[order][:-1]) & (span[order][1:] == span[order][:-1])
                            & (context[order][1:] == context[order][:-1]))
                later = np.zeros(len(order), bool)
                later[order] = same
                twice = later.copy()
                twice[order[:-1]] |= same[1:]
                ok &= ~later | needed_covers(owner, start, left, right, twice, window)
                own = mix64(tid[owner].view(np.uint64) ^ place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                span = np.where(later, own, span)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[ok]) for x in (span.view(np.int64), context.view(np.int64),
                                               tid[owner], place, twice)],
                    ["span", "context", "tid", "place", "twice"])

    return docs.select("text", "tid").mapInArrow(
        find, "span long, context long, tid long, place long, twice boolean")


def marked(rows: DataFrame) -> DataFrame:
    """(need, span, tid, place). ``need`` false: the whole context repeats. True: one row for
    each context of a span that has two or more. Reads a sorted stream, one row ahead."""
    rows = (rows.repartition("span").sortWithinPartitions("span", "context", "tid", "place")
            .select("span", "context", "tid", "place", "twice"))

    def mark(batches):
        before = None                # (span, context) ahead of the rows at hand
        held = None                  # the last row, whose successor is not known yet
        first = None                 # first row of the open span while it has one context

        def told(cols, last: bool):
            nonlocal before, held, first
            span, context, tid, place, twice = cols
            n = len(span)
            if not n:
                return None
            old_span = np.empty(n, bool)
            old = np.empty(n, bool)
            old_span[1:] = span[1:] == span[:-1]
            old[1:] = old_span[1:] & (context[1:] == context[:-1])
            old_span[0] = before is not None and before[0] == span[0]
            old[0] = old_span[0] and before[1] == context[0]
            again = old | twice
            again[:-1] |= old[1:]
            m = n if last else n - 1
            held = None if last else tuple(c[m:] for c in cols)
            if not m:
                return None
            before = (span[m - 1], context[m - 1])
            cover = np.flatnonzero(again[:m])
            lead = ~old[:m]
            group = np.cumsum(~old_span[:m])         # 0: the span that was open
            later = lead & old_span[:m]              # a further context of its span
            several = np.zeros(group[-1] + 1, bool)
            several[group[later]] = True
            need = np.flatnonzero(later | (~old_span[:m] & several[group]))
            parts = [(np.zeros(len(cover), bool), *(c[cover] for c in (span, tid, place))),
                     (np.ones(len(need), bool), *(c[need] for c in (span, tid, place)))]
            if first is not None and several[0]:
                parts.append((np.ones(1, bool), *first))
                first = None
            if group[-1] > 0:
                k = np.flatnonzero(~old_span[:m])[-1]
                first = (None if several[-1]
                         else tuple(c[k: k + 1] for c in (span, tid, place)))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in zip(*parts)], ["need", "span", "tid", "place"])

        for batch in batches:
            if batch.num_rows:
                cols = tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
                if held is not None:
                    cols = tuple(np.concatenate((h, c)) for h, c in zip(held, cols))
                out = told(cols, last=False)
                if out is not None:
                    yield out
        if held is not None:
            out = told(held, last=True)
            if out is not None:
                yield out

    return rows.mapInArrow(mark, "need boolean, span long, tid long, place long")


# ── deep-shallow sort ─────────────────────────────────────────────────


class BlindTrie:
    """Patricia trie that stores only branching depths and bytes; strings are compared in
    full once per insertion, with the leaf that the blind descent ends in."""

    def __init__(self):
        self.root = None             # leaf: list of string numbers; node: [depth, {byte: child}]

    @staticmethod
    def _common(s: bytes, t: bytes) -> int:
        lo, hi = 0, len(s)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if s[lo:mid] == t[lo:mid]:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def insert(self, strings: list[bytes], k: int) -> None:
        s = strings[k]
        if self.root is None:
            self.root = (-1, [k])
            return
        node = self.root
        while node[0] >= 0:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        depth = self._common(s, strings[node[1][0]])
        if depth == len(s):
            node[1].append(k)
            return
        parent, node = None, self.root
        while 0 <= node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if node[0] == depth:
            node[1][s[depth]] = (-1, [k])
            return
        leaf = node
        while leaf[0] >= 0:
            leaf = next(iter(leaf[1].values()))
        new = (depth, {strings[leaf[1][0]][depth]: node, s[depth]: (-1, [k])})
        if parent is None:
            self.root = new
        else:
            parent[1][s[parent[0]]] = new

    def ordered(self) -> Iterator[int]:
        stack = [self.root] if self.root else []
        while stack:
            depth, below = stack.pop()
            if depth < 0:
                yield from below
            else:
                stack.extend(below[b] for b in sorted(below, reverse=True))


def deep_shallow(group: np.ndarray, text: np.ndarray, size: np.ndarray):
    """Order of padded strings (rows of ``text``) within each group, and the common prefix
    of each with the one before it in that order (-1 at the first of a group)."""
    n = len(group)
    words = text.reshape(n, -1, 8).view(">u8").reshape(n, -1)
    order = np.lexsort((size, group))
    tie = group[order]
    for depth in range(SHALLOW // 8):
        at = sliding_runs(tie)
        many = np.diff(np.append(at, n))
        where = np.flatnonzero(np.repeat(many > 1, many))
        if not len(where):
            break
        run = np.repeat(np.arange(len(at)), many)
        key = words[order[where], depth].astype(np.uint64)
        inner = np.lexsort((size[order[where]], key, run[where]))
        order[where] = order[where][inner]
        key_at = np.zeros(n, np.uint64)
        key_at[where] = key[inner]
        split = np.ones(n, bool)
        split[1:] = (run[1:] != run[:-1]) | (key_at[1:] != key_at[:-1])
        tie = np.cumsum(split)
    at = sliding_runs(tie)
    many = np.diff(np.append(at, n))
    for a, k in zip(at[many > 1], many[many > 1]):
        rows = order[a: a + k]
        deep = [text[r, SHALLOW:].tobytes() for r in rows]
        trie = BlindTrie()
        for i in range(k):
            trie.insert(deep, i)
        order[a: a + k] = rows[list(trie.ordered())]
    common = np.full(n, -1, np.int64)
    if n > 1:
        a, b = order[:-1], order[1:]
        for s in range(0, n - 1, MEMBERS):
            x, y = a[s: s + MEMBERS], b[s: s + MEMBERS]
            differ = text[x] != text[y]
            first = np.where(differ.any(axis=1), differ.argmax(axis=1), text.shape[1])
            common[s + 1: s + 1 + len(x)] = np.where(
                group[x] == group[y], np.minimum(first, np.minimum(size[x], size[y])), -1)
    return order, common


def repeated_offsets(group: np.ndarray, before, before_size, behind, behind_size, window: int = WINDOW):
    """(lowest, highest) offset ``a`` at which the ``window`` bytes that start ``a`` bytes before the
    span also occur in another member of the group; highest is -1 if there is none."""
    n, side = len(group), halves(window)[1]
    l_order, l_common = deep_shallow(group, before, before_size)
    r_order, r_common = deep_shallow(group, behind, behind_size)
    low, high = np.full(n, side + 1), np.full(n, -1)
    left, right = np.empty(n, np.int64), np.empty(n, np.int64)
    for a in range(side + 1):
        left[l_order] = np.cumsum(l_common < a)
        right[r_order] = np.cumsum(r_common < side - a)
        both = left * (n + 1) + right
        order = np.argsort(both, kind="stable")
        same = both[order][1:] == both[order][:-1]
        twice = np.zeros(n, bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        high[twice] = a
        np.minimum(low, a, out=low, where=twice)
    return low, high


def _padded(col: pa.Array, backward: bool, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of up to ``side`` bytes as rows of a matrix of whole 8-byte words."""
    side = -(-max(side, SHALLOW) // 8) * 8
    parts = col.to_pylist()
    size = np.array([len(p) for p in parts], np.int64)
    grid = np.zeros((len(parts), side), np.uint8)
    place = np.arange(side)[None, :]
    grid[place >= side - size[:, None] if backward else place < size[:, None]] = np.frombuffer(
        b"".join(parts), np.uint8)
    return np.ascontiguousarray(grid[:, ::-1]) if backward else grid, size


def swept(contexts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Covered intervals (tid, start, end) from ``contexts(span, tid, start, before, behind)``."""
    rows = (contexts.repartition("span").sortWithinPartitions("span", "tid", "start")
            .select("span", "tid", "start", "before", "behind"))

    def sweep(t: pa.Table):
        span, tid, start = (t.column(k).to_numpy() for k in range(3))
        new = np.ones(len(span), bool)            # copies of a text give the same row twice
        new[1:] = (span[1:] != span[:-1]) | (tid[1:] != tid[:-1]) | (start[1:] != start[:-1])
        t = t.filter(pa.array(new)).combine_chunks()
        span, tid, start = span[new], tid[new], start[new]
        group = np.cumsum(np.concatenate(([0], span[1:] != span[:-1])))
        side = halves(window)[1]
        before, before_size = _padded(t.column(3), backward=True, side=side)
        behind, behind_size = _padded(t.column(4), backward=False, side=side)
        low, high = repeated_offsets(group, before, before_size, behind, behind_size, window)
        ok = high >= 0
        return pa.RecordBatch.from_arrays(
            [pa.array(tid[ok]), pa.array(start[ok] - high[ok]), pa.array(start[ok] - low[ok] + window)],
            ["tid", "start", "end"])

    def read(batches):
        held: list[pa.RecordBatch] = []
        rows_held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows_held += batch.num_rows
            if rows_held < MEMBERS:
                continue
            t = pa.Table.from_batches(held)
            span = t.column(0).to_numpy()
            cut = int(np.searchsorted(span, span[-1]))
            if not cut:
                continue
            at = sliding_runs(span[:cut])
            begin = 0
            while begin < cut:
                k = int(np.searchsorted(at, begin + MEMBERS, "right")) - 1
                end = int(at[k]) if k >= 0 and at[k] > begin else 0
                if not end or begin + MEMBERS >= cut:
                    later = at[at > begin]
                    end = cut if begin + MEMBERS >= cut or not len(later) else int(later[0])
                yield sweep(t.slice(begin, end - begin))
                begin = end
            held = t.slice(cut).to_batches()
            rows_held = t.num_rows - cut
        if held:
            yield sweep(pa.Table.from_batches(held))

    return rows.mapInArrow(read, "tid long, start long, end long")


# ── texts ─────────────────────────────────────────────────────────────


def united(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def covers(base: DataFrame, lengths: DataFrame, window: int, with_texts: bool) -> tuple[DataFrame, DataFrame]:
    """(tid, cover): an array of covered intervals of every text of ``base(text, tid)`` that loses
    bytes; and (tid, text) of those that don't lose all bytes (``with_texts``). ``lengths`` as
    ``identified`` gives them."""
    span_size = halves(window)[0]
    marks = stored(marked(anchors(base, window)), "suffix-marks")
    whole = marks.where("not need").select(
        "tid", F.expr("shiftright(place, 16) - (shiftright(place, 8) & 255)").alias("start"),
        F.expr(f"shiftright(place, 16) + {span_size} + (place & 255)").alias("end"))
    copies = lengths.where(f"n > 1 and n_bytes >= {window}").select(
        "tid", F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))
    known = whole.where(f"end - start >= {window}").unionByName(copies)
    need = marks.where("need").groupBy("tid").agg(F.collect_set(F.struct("span", "place")).alias("at"))
    if with_texts:
        # texts that lose bytes without a comparison, but not all their bytes: how far the cover reaches from 0
        reach = F.aggregate(F.array_sort("known"), F.lit(0).cast("long"), lambda r, x: F.when(
            x["start"] <= r, F.greatest(r, x["end"])).otherwise(r))
        partial = (known.groupBy("tid").agg(F.collect_set(F.struct("start", "end")).alias("known"))
                   .join(lengths, "tid").where(reach < F.col("n_bytes")).select("tid"))
        need = need.join(partial, "tid", "full")
    texts = (base.where(F.octet_length("text") >= window)
             .join(need, "tid").select("tid", "text", "at"))

    def contexts(batches):
        seen: set[int] = set()
        schema = pa.schema([("span", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()),
                            ("before", pa.binary()), ("behind", pa.binary()), ("text", pa.string())])
        for batch in batches:
            for tid, text, at in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if tid in seen:
                    continue
                seen.add(tid)
                raw = text.encode()
                cols: tuple[list, ...] = ([], [], [], [], [], [])
                for x in at or ():
                    start, left, right = x["place"] >> 16, (x["place"] >> 8) & 255, x["place"] & 255
                    behind = start + span_size
                    row = (x["span"], tid, start, raw[start - left: start], raw[behind: behind + right],
                           None)
                    for c, v in zip(cols, row):
                        c.append(v)
                if with_texts:
                    for c, v in zip(cols, (None, tid, None, None, None, text)):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    got = stored(texts.mapInArrow(contexts, "span long, tid long, start long, before binary, "
                                            "behind binary, text string"), "suffix-contexts")
    cover = (swept(got.where("span is not null"), window).unionByName(known).distinct()
             .groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("cover")))
    return cover, got.where("span is null").select("tid", "text")


def cut_texts(base: DataFrame, lengths: DataFrame, window: int = WINDOW) -> DataFrame:
    """(tid, n_removed, n_spans, kept_sha256, kept, kept_text) of every text of ``base(text, tid)``
    that loses bytes: what remains as bytes, and as a string without the bytes of broken
    characters."""
    cover, texts = covers(base, lengths, window, with_texts=True)
    pieces = cover.join(lengths.select("tid", "n_bytes"), "tid").join(texts, "tid", "left")

    def cut(batches):
        schema = pa.schema([("tid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                            ("kept_sha256", pa.string()), ("kept", pa.binary()),
                            ("kept_text", pa.string())])
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [], [])
            for tid, cover, n_bytes, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                spans = united([(x["start"], x["end"]) for x in cover])
                if text is None:             # only a text that goes entirely is not fetched
                    if spans != [(0, n_bytes)]:
                        raise ValueError(f"no text for {tid}")
                    kept = b""
                else:
                    raw, at, left = text.encode(), 0, []
                    for a, b in spans:
                        left.append(raw[at:a])
                        at = b
                    left.append(raw[at:])
                    kept = b"".join(left)
                row = (tid, sum(b - a for a, b in spans), len(spans),
                       hashlib.sha256(kept).hexdigest(), kept, kept.decode("utf-8", "ignore"))
                for c, v in zip(out, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return (pieces.select("tid", "cover", "n_bytes", "text")
            .mapInArrow(cut, "tid long, n_removed long, n_spans long, kept_sha256 string, "
                             "kept binary, kept_text string")
            .dropDuplicates(["tid"]))


def covered_bytes(base: DataFrame, lengths: DataFrame, window: int) -> DataFrame:
    """(tid, n_covered): how many bytes repeated strings of ``window`` bytes cover in every text of
    ``base(text, tid)`` that holds one."""
    cover, _ = covers(base, lengths, window, with_texts=False)
    # sum of the intervals' parts behind all intervals before them
    state = F.aggregate(F.array_sort("cover"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                        lambda s, x: F.struct((s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["to"]), F.lit(0))).alias("n"),
                                              F.greatest(s["to"], x["end"]).alias("to")))
    return cover.select("tid", state["n"].alias("n_covered"))


def removal_report(docs: DataFrame, window: int = WINDOW, passage: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of ``docs``; with
    ``passage`` also ``passage_bytes``: how many bytes repeated strings of that many bytes (at
    most ``window``) cover."""
    least = min(window, passage or window)
    keyed, lengths = identified(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), least)
    base = keyed.select("text", "tid")
    changed = cut_texts(base, lengths, window).drop("kept", "kept_text")
    every = keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                         F.sha2(F.col("text").cast("binary"), 256).alias("sha"), "tid")
    zero = F.lit(0).cast("long")
    more = []
    if passage:
        changed = changed.join(covered_bytes(base, lengths, passage), "tid", "full")
        more = [F.coalesce("n_covered", zero).alias("passage_bytes")]
    return every.join(changed, "tid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), *more)


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated bytes cut out of ``text``; a character that lost a part of its
    bytes goes as a whole. Texts that lose nothing stay as they are (null too)."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    keyed, lengths = identified(rows, window)
    changed = cut_texts(keyed.select("text", "tid"), lengths, window).select("tid", "kept_text")
    return keyed.join(changed, "tid", "left").select(
        *(F.coalesce("kept_text", "row.text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
          for c in docs.columns))
