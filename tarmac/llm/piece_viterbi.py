"""SentencePiece encoding and decoding with a batched numpy Viterbi.

The pieces of a given ``.model`` file (a path, never trained or copied here) and their
scores are read as a unigram lexicon: a text's ids are those of the segmentation with
the greatest sum of scores, ties going to the longer last piece. A character that no
piece covers costs the least score less 10 and is spelled by the model's byte pieces
(the unknown id if it has none). The file's conventions are those of an identity
normaliser with a dummy prefix: a non-empty text gets one leading blank, blanks are
``U+2581`` in pieces, and nothing else changes. Decoding drops that blank again, so
``decode(encode(t)) == t`` but for texts that hold U+2581 themselves (read as blanks;
``round_trip`` is false for them).

Method: no piece holds a blank after another character, so a text falls into words that
begin at a run of blanks (and single characters that no longer piece holds), and the
best segmentation of a text is that of its words. Each distinct word of a chunk is
segmented once. Words of equal length advance together, one end position at a time: the
hashes of all substrings that end there probe the sorted piece keys (behind a bitmap),
and the first of the greatest sums is the back-pointer. The ids of documents are
gathered from their words' ids. One pass, no shuffle; the lexicon is broadcast (its size
is the model's).

Defined cases: null and empty texts have no ids and decode to the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import BASE, mix64, sliding_runs

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_COST = 10.0
CHUNK_CODES = 1 << 21
CELLS = 1 << 20                 # word rows x lengths handled at a time
FILTER_BITS = 20


class Lexicon:
    """Pieces as sorted hashes of their code points, and as bytes for decoding."""

    def __init__(self, path: str = MODEL_PATH):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = m.get_piece_size()
        plain, spelled, self.byte_ids = [], [], np.full(256, -1, np.int32)
        for i in range(self.size):
            piece = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                spelled.append(bytes([int(piece[3:5], 16)]))
            elif m.is_control(i) or m.is_unknown(i):
                spelled.append(" ⁇ ".encode() if m.is_unknown(i) else b"")
            else:
                spelled.append(piece.replace(MARK, " ").encode())
                if not m.is_unused(i):
                    plain.append((piece.replace(MARK, " "), i, m.get_score(i)))
        self.unknown_id = m.unk_id()
        self.longest = max(len(p) for p, _, _ in plain)
        self.unknown_score = min(s for _, _, s in plain) - UNKNOWN_COST
        codes = np.frombuffer("".join(p for p, _, _ in plain).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) for p, _, _ in plain])
        total = prefix_hash(codes)
        start = np.concatenate(([0], ends[:-1]))
        h = span_hash(total, start, ends)
        order = np.argsort(h)
        self.keys = h[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.ids = np.array([i for _, i, _ in plain], np.int32)[order]
        self.scores = np.array([s for _, _, s in plain])[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        inner = {c for p, _, _ in plain if len(p) > 1 for c in p}
        self.alone = np.array([chr(c) not in inner for c in range(128)])   # only ever a piece of their own
        if any(" " in p.lstrip(" ") for p, _, _ in plain):
            raise ValueError("a piece holds a blank after another character")
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.byte_at = np.concatenate(([0], np.cumsum([len(s) for s in spelled])))

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the keys, or -1."""
        out = np.full(h.shape, -1, np.int32)
        at = np.nonzero(self.filter[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        x = h[at]
        k = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        out[at] = np.where(self.keys[k] == x, k, -1)
        return out


_DOWN = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums along the last axis (one longer than ``codes``)."""
    n = codes.shape[-1]
    total = np.zeros((*codes.shape[:-1], n + 1), np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n), axis=-1,
              out=total[..., 1:])
    return total


def span_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64((total[end] - total[start]) * _powers(_DOWN, int(np.max(start, initial=0)) + 1)[start])


# ── segmentation ──────────────────────────────────────────────────────


def segment(lexicon: Lexicon, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of one length (rows of code points) → pieces per word and, row by row, all
    pieces: key indices, or ``-1 - code point`` where no piece covers a character."""
    n, length = codes.shape
    total = prefix_hash(codes)
    down = _powers(_DOWN, length + 1)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back = np.zeros((n, length + 1), np.int32)
    piece = np.full((n, length + 1), -1, np.int32)
    row = np.arange(n)
    for end in range(1, length + 1):
        first = max(0, end - lexicon.longest)
        h = mix64((total[:, end: end + 1] - total[:, first:end]) * down[first:end])
        key = lexicon.probe(h)
        gain = np.where(key >= 0, lexicon.scores[key], -np.inf)
        gain[:, -1] = np.where(key[:, -1] >= 0, gain[:, -1], lexicon.unknown_score)
        gain += best[:, first:end]
        k = gain.argmax(axis=1)                   # the earliest start of equals
        best[:, end] = gain[row, k]
        back[:, end] = first + k
        piece[:, end] = key[row, k]
    out = np.zeros((n, length), np.int64)
    used = np.zeros((n, length), bool)
    at = np.full(n, length)
    open_rows = row
    for col in range(length - 1, -1, -1):
        if not len(open_rows):
            break
        end = at[open_rows]
        p = piece[open_rows, end]
        start = back[open_rows, end]
        out[open_rows, col] = np.where(p >= 0, p, -1 - codes[open_rows, start].astype(np.int64))
        used[open_rows, col] = True
        at[open_rows] = start
        open_rows = open_rows[start > 0]
    return used.sum(axis=1), out[used]


def word_bounds(lexicon: Lexicon, codes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where words begin; the end of the chunk comes last."""
    n = len(codes)
    blank = codes == 32
    alone = lexicon.alone[np.minimum(codes, np.uint32(127))] & (codes < 128) & ~blank
    cut = np.zeros(n + 1, bool)
    cut[:n] = alone
    cut[1:] |= alone                              # such a character stands by itself
    cut[1:n] |= blank[1:] & ~blank[:-1]
    cut[offs] = True
    cut[n] = True
    return np.flatnonzero(cut)


def word_ids(lexicon: Lexicon, codes: np.ndarray, start: np.ndarray, size: np.ndarray):
    """(number of ids, place of the first in the ids, ids) of words of ``codes``."""
    order = np.argsort(size, kind="stable")
    many = np.zeros(len(start), np.int64)
    parts = []
    at = sliding_runs(size[order])
    for a, b in zip(at, np.append(at[1:], len(order))):
        length = int(size[order[a]])
        step = max(1, CELLS // length)
        for s in range(a, b, step):
            rows = order[s: min(s + step, b)]
            grid = codes[start[rows][:, None] + np.arange(length)[None, :]]
            many[rows], pieces = segment(lexicon, grid)
            parts.append(pieces)
    pieces = np.concatenate(parts)
    known = pieces >= 0
    ids = np.full(len(pieces), lexicon.unknown_id, np.int32)
    ids[known] = lexicon.ids[pieces[known]]
    ordered = many[order]
    if not known.all() and (lexicon.byte_ids >= 0).all():      # spell the unknown by bytes
        spelled = {int(p): np.frombuffer(chr(-1 - int(p)).encode("utf-8", "surrogatepass"), np.uint8)
                   for p in np.unique(pieces[~known])}
        width = np.ones(len(pieces), np.int64)
        width[~known] = [len(spelled[int(p)]) for p in pieces[~known]]
        wide = np.repeat(ids, width)
        begin = np.cumsum(width) - width
        for k in np.flatnonzero(~known):
            wide[begin[k]: begin[k] + width[k]] = lexicon.byte_ids[spelled[int(pieces[k])]]
        ordered = np.add.reduceat(width, np.cumsum(ordered) - ordered)
        ids = wide
    first = np.zeros(len(start), np.int64)
    first[order] = np.cumsum(ordered) - ordered
    many[order] = ordered
    return many, first, ids


class KnownWords:
    """Ids of words that a task has met, by the words' hash; begins anew when it is full."""

    def __init__(self, limit: int = 1 << 20):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.many = self.first = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def add(self, hashes, many, first, ids) -> None:
        if len(self.hashes) + len(hashes) > self.limit:
            self.clear()
        h = np.concatenate((self.hashes, hashes))
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.many = np.concatenate((self.many, many))[order]
        self.first = np.concatenate((self.first, first + len(self.ids)))[order]
        self.ids = np.concatenate((self.ids, ids))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each hash, and whether it is known."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        k = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return k, self.hashes[k] == hashes


def chunk_ids(lexicon: Lexicon, codes: np.ndarray, offs: np.ndarray,
              words: KnownWords) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a chunk and where each document's begin. ``codes`` holds the
    texts with their leading blank."""
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
    bounds = word_bounds(lexicon, codes, offs)
    start, end = bounds[:-1], bounds[1:]
    total = prefix_hash(codes)
    h = mix64((total[end] - total[start]) * _powers(_DOWN, len(codes) + 1)[start])
    h, one, which = np.unique(h, return_index=True, return_inverse=True)
    k, known = words.find(h)
    many, first = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
    ids = words.ids
    many[known], first[known] = words.many[k[known]], words.first[k[known]]
    if not known.all():
        new = np.flatnonzero(~known)
        m, f, more = word_ids(lexicon, codes, start[one[new]], (end - start)[one[new]])
        many[new], first[new] = m, f + len(ids)
        ids = np.concatenate((ids, more))
        words.add(h[new], m, f, more)
    n = many[which]
    ahead = np.cumsum(n)
    flat = ids[np.repeat(first[which] - (ahead - n), n) + np.arange(ahead[-1])]
    return flat, np.concatenate(([0], ahead))[np.searchsorted(start, offs)]


def chunks(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, code points with leading blanks, offsets)."""
    k = 0
    while k < len(texts):
        a, size, lens = k, 0, []
        parts = []
        while k < len(texts) and (not lens or size < CHUNK_CODES):
            t = " " + texts[k].replace(MARK, " ") if texts[k] else ""
            parts.append(t)
            lens.append(len(t))
            size += len(t)
            k += 1
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        yield a, k, codes, np.concatenate(([0], np.cumsum(lens)))


def encode_array(lexicon: Lexicon, col: pa.Array, words: KnownWords | None = None) -> pa.ListArray:
    words = words or KnownWords()
    texts = pc.fill_null(col, "").to_pylist()
    values, offsets, base = [], [np.zeros(1, np.int64)], 0
    for _, _, codes, offs in chunks(texts):
        ids, at = chunk_ids(lexicon, codes, offs, words)
        values.append(ids)
        offsets.append(at[1:] + base)
        base += len(ids)
    ids = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)),
                                    pa.array(ids, pa.int32()))


def decode_array(lexicon: Lexicon, ids: pa.ListArray) -> pa.Array:
    """Texts of lists of ids; bytes that are no UTF-8 become U+FFFD, null lists the empty text."""
    flat = ids.flatten().to_numpy().astype(np.int64)
    n = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    out: list[str] = []
    at = np.concatenate(([0], np.cumsum(n)))
    k = 0
    while k < len(n):
        j = max(k + 1, int(np.searchsorted(at, at[k] + CHUNK_CODES, "right")) - 1)
        part = flat[at[k]: at[j]]
        width = lexicon.byte_at[part + 1] - lexicon.byte_at[part]
        ahead = np.cumsum(width)
        size = int(ahead[-1]) if len(ahead) else 0
        raw = lexicon.bytes[np.repeat(lexicon.byte_at[part] - (ahead - width), width) + np.arange(size)].tobytes()
        ends = np.concatenate(([0], ahead))[at[k: j + 1] - at[k]]
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            t = raw[a:b].decode("utf-8", "replace")
            out.append(t[1:] if t.startswith(" ") else t)
        k = j
    return pa.array(out, pa.string())


# ── Spark ─────────────────────────────────────────────────────────────


def encoded(docs: DataFrame, path: str = MODEL_PATH, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs(doc_id, text)`` → ``(doc_id, text, ids)``."""
    lexicon = docs.sparkSession.sparkContext.broadcast(Lexicon(path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))

    def run(batches):
        words = KnownWords()
        for batch in batches:
            ids = encode_array(lexicon.value, batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], ["doc_id", "text", out])

    return rows.mapInArrow(run, f"doc_id long, text string, {out} array<int>")


def decoded(rows: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``rows(doc_id, ids)`` → ``(doc_id, text)``."""
    lexicon = rows.sparkSession.sparkContext.broadcast(Lexicon(path))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), decode_array(lexicon.value, batch.column(1))], ["doc_id", "text"])

    return (rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
            .mapInArrow(run, "doc_id long, text string"))


def encoded_and_checked(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """(doc_id, ids, n_tokens, round_trip): the ids, and whether they decode to the text."""
    lexicon = docs.sparkSession.sparkContext.broadcast(Lexicon(path))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        words = KnownWords()
        for batch in batches:
            ids = encode_array(lexicon.value, batch.column(1), words)
            back = decode_array(lexicon.value, ids)
            same = pc.equal(back, pc.fill_null(batch.column(1), ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, pc.list_value_length(ids).cast(pa.int64()), same],
                ["doc_id", "ids", "n_tokens", "round_trip"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, round_trip boolean")
