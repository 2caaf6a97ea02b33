"""Toxicity from class-conditional Kneser-Ney models of the spelling of words.

A word is a run of letters; it is spelled by symbols (a-z, ``FOREIGN`` classes of other
letters, a start and an end). Two models, toxic and ordinary, give each symbol a
probability from the ``ORDER - 1`` symbols before it::

    P_c(x | h) = max(n_c(h x) - D_c, 0) / n_c(h) + D_c * types_c(h) / n_c(h) * P(x | h')

Their counts come from labelled documents. Shorter contexts are shared by both:
``P(x | h')``, of the last ``SHARED - 2`` symbols, is interpolated Kneser-Ney over
continuation counts (how many symbols stand before) of the words of all documents, labelled
or not. So an expression that the labels hold rarely, or with another ending, is judged by
its parts, and what neither class has seen is judged alike by both. ``ORDER`` is the most
that packs into 64 bits: up to its ninth letter a word's symbols are judged after all of the
word before them, so a stem made of common pieces is counted as a beginning of words, apart
from the same letters inside others.

A word's evidence is the difference of its two log-likelihoods. A document's are the
evidence per symbol of its whole text and that of its strongest words (first, and mean of
the first three); a logistic regression turns them into the score.

Training: at most ``TRAIN_DOCS`` labelled documents of each class, those with the least
hash of doc_id, none of them held out (crc32 of doc_id mod ``FOLDS`` = ``HELD_OUT_FOLD``);
three quarters for the counts, the rest for the regression. Grams are packed integers of
``ORDER`` symbols. Up to ``MAX_GRAMS`` of them are broadcast. Beyond, their evidence stays a
written table: it is joined with the grams of the distinct words of the corpus, and the
words with the documents; the ``KNOWN_WORDS`` most common words are broadcast, so that only
the others of a text are shuffled. Scores are the same either way.

Defined cases: null and empty texts and texts without letters score by the regression's
constant; null doc_ids are scored, not held out and never train; a doc_id that repeats in
the labels is toxic if any row says so; without labels of both kinds every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import CHUNK_BYTES, SpanHash, byte_codes, sliding_runs, stored
from tarmac.llm.line_crf import held_out

ORDER, SHARED = 10, 7         # ORDER * BITS < 64
BITS = 6
MAX_GRAMS = 4_000_000
TRAIN_DOCS = 6000
FOLDS, HELD_OUT_FOLD = 5, 0
THRESHOLD = 0.5
START, END = 62, 63
FOREIGN = START - 27
KNOWN_WORDS = 1 << 20

_SYMBOL = np.zeros(0x250, np.uint8)           # 0: no letter
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[0xC0:] = 1
_SYMBOL[[0xD7, 0xF7]] = 0


# ── words ─────────────────────────────────────────────────────────────


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol of every code point of the lower-cased texts, and the texts' offsets."""
    low = [t.lower() for t in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = _SYMBOL[np.minimum(codes, len(_SYMBOL) - 1)]
    far = codes >= 0xC0
    if far.any():
        c = codes[far]
        mark = (c >= 0x2000) & (c < 0x2C00) | (c >= 0x3000) & (c < 0x3040) | (c == 0xD7) | (c == 0xF7)
        out[far] = np.where(mark, 0, 27 + (c * np.uint32(0x9E3779B1) >> np.uint32(8)) % FOREIGN)
    return out, np.concatenate(([0], np.cumsum([len(t) for t in low])))


def words(sym: np.ndarray, offs: np.ndarray):
    """(hashes of the distinct words, start and length of one of each, for every word its
    number among them, first word of each document)."""
    n = len(sym)
    ink = sym > 0
    before = np.zeros(n, bool)
    before[1:] = ink[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = ink[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    start = np.flatnonzero(ink & ~before)
    end = np.flatnonzero(ink & ~after) + 1
    first = np.searchsorted(start, offs)
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, first
    h = SpanHash(sym, byte_codes(fold_case=False))(start, end)
    h, one, which = np.unique(h, return_index=True, return_inverse=True)
    return h, start[one], (end - start)[one], which, first


def grams(sym: np.ndarray, start: np.ndarray, size: np.ndarray, order: int):
    """(packed grams of the words, one for each symbol and the end; the words they are of)."""
    many = size + 1
    word = np.repeat(np.arange(len(start)), many)
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    begin, length = start[word], size[word]
    g = np.zeros(len(word), np.int64)
    for k in range(order):
        p = at - (order - 1) + k
        inside = (p >= 0) & (p < length)
        value = np.where(inside, sym[np.where(inside, begin + p, 0)], np.where(p < 0, START, END))
        g = (g << BITS) | value
    return g, word


def chunks(texts: list[str]):
    k = 0
    while k < len(texts):
        a, size = k, 0
        while k < len(texts) and (k == a or size < CHUNK_BYTES // 2):
            size += len(texts[k])
            k += 1
        yield a, k


def gram_counts(docs: DataFrame, order: int) -> DataFrame:
    """(g, toxic, ordinary) of grams of ``order`` symbols over ``docs(text, label)``; grams of unlabelled rows count 0."""
    def count(batches):
        held: list[tuple] = []
        size = 0

        def merged():
            g, t, o = (np.concatenate(c) for c in zip(*held))
            by = np.argsort(g, kind="stable")
            g, t, o = g[by], t[by], o[by]
            at = sliding_runs(g)
            return g[at], np.add.reduceat(t, at), np.add.reduceat(o, at)

        for batch in batches:
            texts = pc.fill_null(batch.column(0), "").to_pylist()
            label = pc.fill_null(batch.column(1), -1).to_numpy()
            for a, b in chunks(texts):
                sym, offs = symbols(texts[a:b])
                h, start, length, which, first = words(sym, offs)
                if not len(h):
                    continue
                of = np.repeat(label[a:b], np.diff(first))
                toxic = np.bincount(which[of == 1], minlength=len(h))
                ordinary = np.bincount(which[of == 0], minlength=len(h))
                g, word = grams(sym, start, length, order)
                held.append((g, toxic[word], ordinary[word]))
                size += len(g)
                if size > 1 << 22:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 1 << 21:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["g", "toxic", "ordinary"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged()], ["g", "toxic", "ordinary"])

    return (docs.select("text", F.col("label").cast("long").alias("label"))
            .mapInArrow(count, "g long, toxic long, ordinary long")
            .groupBy("g").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


# ── model ─────────────────────────────────────────────────────────────


@dataclass
class Model:
    order: int
    grams: np.ndarray            # sorted
    evidence: np.ndarray
    contexts: np.ndarray         # sorted; evidence of symbols never seen after them
    context_evidence: np.ndarray
    weights: np.ndarray | None = None

    def of_words(self, sym: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        g, word = grams(sym, start, size, self.order)
        out = _look_up(self.grams, self.evidence, g)
        rare = np.flatnonzero(np.isnan(out))
        if len(rare):
            out[rare] = np.nan_to_num(_look_up(self.contexts, self.context_evidence, g[rare] >> BITS))
        return np.bincount(word, out, len(start))


@dataclass
class Tables:
    """The same evidence as written tables: (g, e) of grams, (h, e) of contexts."""
    grams: DataFrame
    contexts: DataFrame
    features: DataFrame | None = None
    weights: np.ndarray | None = None


def _look_up(keys: np.ndarray, values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(x), np.nan)
    k = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[k] == x, values[k], np.nan)


def discount(table: DataFrame, column: str) -> float:
    """The usual estimate from how many counts are one and two, kept within (0.1, 0.95)."""
    one, two = table.agg(F.count_if(F.col(column) == 1), F.count_if(F.col(column) == 2)).first()
    return min(max(one / (one + 2 * two), 0.1), 0.95) if one else 0.5


def shared_backoff(table: DataFrame, order: int) -> DataFrame:
    """(s, p): probability of the last symbol of each gram of ``order - 1`` symbols after the
    others, interpolated Kneser-Ney over continuation counts."""
    level = {}
    rows = table.select("g")
    for o in range(order - 1, 0, -1):
        rows = stored(rows.groupBy((F.col("g").bitwiseAND((1 << (BITS * o)) - 1)).alias("g"))
                      .agg(F.count(F.lit(1)).alias("c")), "kn-level")
        level[o] = rows
    total, types = level[1].agg(F.sum("c"), F.count(F.lit(1))).first()
    d = discount(level[1], "c")
    p = level[1].select("g", ((F.greatest(F.col("c") - d, F.lit(0.0)) + d * types / (1 << BITS)) / total).alias("p"))
    for o in range(2, order):
        d = discount(level[o], "c")
        rows = level[o].withColumn("h", F.shiftright("g", BITS))
        after = rows.groupBy("h").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("types"))
        low = p.select(F.col("g").alias("low"), F.col("p").alias("p_low"))
        p = (rows.join(after, "h").join(low, F.col("g").bitwiseAND((1 << (BITS * (o - 1))) - 1) == F.col("low"))
             .select("g", ((F.greatest(F.col("c") - d, F.lit(0.0)) + d * F.col("types") * F.col("p_low"))
                           / F.col("n")).alias("p")))
    return p.select(F.col("g").alias("s"), "p")


def fit_counts(docs: DataFrame) -> Model | Tables:
    """The two models from ``docs(text, label)``, as evidence per gram."""
    order = ORDER
    table = stored(gram_counts(docs.where("label is not null"), order), "kn-grams")
    if not table.take(1):
        none = np.zeros(0)
        return Model(order, none.astype(np.int64), none, none.astype(np.int64), none)
    d = {c: discount(table, c) for c in ("toxic", "ordinary")}
    rows = table.withColumn("h", F.shiftright("g", BITS))
    after = rows.groupBy("h").agg(*(x for c in d for x in (
        F.sum(c).alias(f"n_{c}"), F.count_if(F.col(c) > 0).alias(f"types_{c}"))))
    rest = {c: F.when(F.col(f"n_{c}") > 0, d[c] * F.col(f"types_{c}") / F.col(f"n_{c}")).otherwise(1.0) for c in d}
    p = {c: F.when(F.col(f"n_{c}") > 0, F.greatest(F.col(c) - d[c], F.lit(0.0)) / F.col(f"n_{c}")).otherwise(0.0)
         + rest[c] * F.col("p") for c in d}
    low = shared_backoff(stored(gram_counts(docs, SHARED).select("g"), "kn-shared"), SHARED)
    found = (rows.join(after, "h")
             .join(low, F.col("g").bitwiseAND((1 << (BITS * (SHARED - 1))) - 1) == F.col("s"))
             .select("g", (F.log(p["toxic"]) - F.log(p["ordinary"])).alias("e")))
    unseen = after.select("h", (F.log(rest["toxic"]) - F.log(rest["ordinary"])).alias("e"))
    if table.count() > MAX_GRAMS:
        return Tables(stored(found, "kn-evidence"), stored(unseen, "kn-contexts"))
    return Model(order, *_sorted_columns(found), *_sorted_columns(unseen))


def _sorted_columns(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of at most ``MAX_GRAMS`` rows, as arrays all the way (16 bytes a row)."""
    rows = table.toArrow()
    keys, values = (c.to_numpy() for c in rows.columns)
    by = np.argsort(keys)
    return keys[by], values[by]


# ── documents ─────────────────────────────────────────────────────────


class KnownWords:
    """Evidence of the words that a task has met, by hash; begins anew when it is full."""

    def __init__(self):
        self.hashes, self.evidence = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, model: Model, sym, hashes, start, size) -> np.ndarray:
        out = _look_up(self.hashes, self.evidence, hashes)
        new = np.flatnonzero(np.isnan(out))
        if len(new):
            out[new] = model.of_words(sym, start[new], size[new])
            if len(self.hashes) + len(new) > KNOWN_WORDS:
                self.__init__()
            h = np.concatenate((self.hashes, hashes[new]))
            order = np.argsort(h, kind="stable")
            self.hashes, self.evidence = h[order], np.concatenate((self.evidence, out[new]))[order]
        return out


def document_features(model: Model, texts: list[str], known: KnownWords) -> np.ndarray:
    """Per text: evidence per symbol, evidence of the strongest word, mean of the three
    strongest (absent ones count 0)."""
    out = np.zeros((len(texts), 3))
    for a, b in chunks(texts):
        sym, offs = symbols(texts[a:b])
        h, start, size, which, first = words(sym, offs)
        if not len(h):
            continue
        e = known.of(model, sym, h, start, size)[which]
        n = (size + 1)[which]
        for d in range(b - a):
            x = e[first[d]: first[d + 1]]
            if len(x):
                top = np.partition(x, len(x) - 3)[-3:] if len(x) > 3 else x
                out[a + d] = x.sum() / n[first[d]: first[d + 1]].sum(), x.max(), np.maximum(top, 0).sum() / 3
    out[:, 1:] = np.clip(out[:, 1:], 0, 20)
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """(w, spelling, times) of the distinct words of ``docs(tid, text)``."""
    def find(batches):
        held: dict[int, list] = {}

        def told():
            w = pa.array(list(held), pa.int64())
            spelling, times = zip(*held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([w, pa.array(spelling, pa.binary()), pa.array(times, pa.int64())],
                                              ["w", "spelling", "times"])

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                sym, offs = symbols(texts[a:b])
                h, start, size, which, _ = words(sym, offs)
                many = np.bincount(which, minlength=len(h)).tolist()
                for w, at, n, k in zip(h.view(np.int64).tolist(), start.tolist(), size.tolist(), many):
                    if w in held:
                        held[w][1] += k
                    else:
                        held[w] = [sym[at: at + n].tobytes(), k]
                if len(held) > KNOWN_WORDS:
                    yield told()
        if held:
            yield told()

    return (docs.select("tid", "text").mapInArrow(find, "w long, spelling binary, times long")
            .groupBy("w").agg(F.min("spelling").alias("spelling"), F.sum("times").alias("times")))


def word_evidence(docs: DataFrame, tables: Tables) -> DataFrame:
    """(w, e, times): evidence of the distinct words, summed in the order of their symbols."""
    def spelled(batches):
        for batch in batches:
            parts = batch.column(1).to_pylist()
            size = np.array([len(x) for x in parts], np.int64)
            sym = np.frombuffer(b"".join(parts), np.uint8)
            g, word = grams(sym, np.cumsum(size) - size, size, ORDER)
            at = np.arange(len(g)) - (np.cumsum(size + 1) - size - 1)[word]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (batch.column(0).to_numpy()[word], at, g)], ["w", "at", "g"])

    known = stored(vocabulary(docs), "kn-vocabulary")
    found, unseen = tables.grams.withColumnRenamed("e", "e_gram"), tables.contexts.withColumnRenamed("e", "e_context")
    rows = (known.select("w", "spelling").mapInArrow(spelled, "w long, at long, g long")
            .join(found, "g", "left").withColumn("h", F.shiftright("g", BITS)).join(unseen, "h", "left")
            .select("w", F.struct("at", F.coalesce("e_gram", "e_context", F.lit(0.0)).alias("e")).alias("x")))
    total = F.aggregate(F.array_sort(F.collect_list("x")), F.lit(0.0), lambda s, x: s + x["e"])
    return rows.groupBy("w").agg(total.alias("e")).join(known.select("w", "times"), "w")


def joined_features(docs: DataFrame, tables: Tables) -> DataFrame:
    """(tid, a, b, c): ``document_features`` of the distinct texts that have words."""
    evidence = stored(word_evidence(docs, tables), "kn-words")
    hot = (evidence.orderBy(F.desc("times"), "w").limit(KNOWN_WORDS).select("w", "e")
           .toPandas().sort_values("w"))                        # at most KNOWN_WORDS rows
    shared = docs.sparkSession.sparkContext.broadcast((hot["w"].to_numpy(), hot["e"].to_numpy()))

    def look(batches):
        # a row of each text (w: the tid) with its common words, and one of each other word
        schema = pa.schema([("tid", pa.int64()), ("w", pa.int64()), ("times", pa.int64()),
                            ("total", pa.float64()), ("n", pa.int64()), ("top", pa.list_(pa.float64()))])
        for batch in batches:
            tids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                sym, offs = symbols(texts[a:b])
                h, _, size, which, first = words(sym, offs)
                h = h.view(np.int64)
                e = _look_up(*shared.value, h)
                out: tuple[list, ...] = ([], [], [], [], [], [])
                for d in range(b - a):
                    x = which[first[d]: first[d + 1]]
                    if not len(x):
                        continue
                    v = e[x]
                    met = v[~np.isnan(v)]
                    other, times = np.unique(x[np.isnan(v)], return_counts=True)
                    k = len(other)
                    for c, one, more in zip(
                            out, (tids[a + d], tids[a + d], 1, met.sum(), (size + 1)[x].sum(), np.sort(met)[-3:]),
                            ([tids[a + d]] * k, h[other].tolist(), times.tolist(), [None] * k, [None] * k, [None] * k)):
                        c.append(one)
                        c.extend(more)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    rows = (docs.select("tid", "text")
            .mapInArrow(look, "tid long, w long, times long, total double, n long, top array<double>")
            .dropDuplicates(["tid", "w"])                       # copies of a text
            .join(evidence.select("w", "e"), "w", "left"))
    few = F.expr("array_repeat(e, cast(least(times, 3) as int))")
    rows = rows.groupBy("tid").agg(
        F.sum(F.coalesce("total", F.col("e") * F.col("times"))).alias("total"), F.sum("n").alias("n"),
        F.slice(F.sort_array(F.flatten(F.collect_list(F.coalesce("top", few))), False), 1, 3).alias("top"))
    best = F.aggregate("top", F.lit(0.0), lambda s, x: s + F.greatest(x, F.lit(0.0)))

    def clipped(x):
        return F.least(F.greatest(x, F.lit(0.0)), F.lit(20.0))

    return rows.select("tid", (F.col("total") / F.col("n")).alias("a"),
                       clipped(F.col("top")[0]).alias("b"), clipped(best / 3).alias("c"))


def with_text_id(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"tid": F.xxhash64(text), "text": text})


def training_ids(labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, label, counted): at most ``limit`` rows of each class."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").alias("label"))
            .where("doc_id is not null and label in (0, 1)")
            .where(~held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
            .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = F.xxhash64(F.lit("toxic"), "doc_id")
    both = [rows.where(F.col("label") == c).orderBy(order, "doc_id").limit(limit) for c in (0, 1)]
    return both[0].unionByName(both[1]).withColumn("counted", F.pmod(order, F.lit(4)) > 0)


def fit_scores(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method: constant, then a weight per feature."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    ridge = np.full(a.shape[1], 0.05)
    ridge[0] = 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        g = a.T @ (weight * (y - p)) - ridge * w
        h = (a * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ a + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model | Tables | None:
    ids = stored(training_ids(labels), "toxic-ids")                 # at most 2 * TRAIN_DOCS rows
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = ids.groupBy("label").count().collect()
    if len(sample) < 2:
        return None
    marked = docs.join(F.broadcast(ids.where("counted").drop("counted")), "doc_id", "left")
    model = fit_counts(marked)
    rest = docs.join(F.broadcast(ids.where("not counted")), "doc_id")
    if isinstance(model, Tables):
        model.features = stored(joined_features(with_text_id(docs), model), "kn-features")
        rest = (with_text_id(rest).join(model.features, "tid", "left")
                .select(F.col("label").cast("long").alias("label"), "a", "b", "c").fillna(0.0, ["a", "b", "c"]))
        return fitted(model, rest)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches):
        known = KnownWords()
        for batch in batches:
            x = document_features(shared.value, pc.fill_null(batch.column(1), "").to_pylist(), known)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x[:, k].copy()) for k in range(3))], ["label", "a", "b", "c"])

    return fitted(model, rest.select(F.col("label").cast("long").alias("label"), "text")
                  .mapInArrow(features, "label long, a double, b double, c double"))


def fitted(model: Model | Tables, rows: DataFrame) -> Model | Tables | None:
    """The model with its regression, from ``rows(label, a, b, c)``: at most 2 * TRAIN_DOCS."""
    rest = rows.toPandas().sort_values(["label", "a", "b", "c"])
    if rest["label"].nunique() < 2:
        return None
    y = rest["label"].to_numpy()
    model.weights = fit_scores(rest[["a", "b", "c"]].to_numpy(), y, np.ones(len(y)))
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    model = train(docs, labels)
    if isinstance(model, Tables):
        known = with_text_id(docs).drop("text").join(model.features, "tid", "left").fillna(0.0, ["a", "b", "c"])
        x = F.lit(float(model.weights[0]))
        for k, column in enumerate("abc", 1):
            x = x + float(model.weights[k]) * F.col(column)
        x = F.least(F.greatest(x, F.lit(-700.0)), F.lit(700.0))
        return scored(known.select(F.col("doc_id").cast("long").alias("doc_id"), (1 / (1 + F.exp(-x))).alias("score")))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        m, known = shared.value, KnownWords()
        for batch in batches:
            out = np.zeros(batch.num_rows)
            if m is not None:
                x = document_features(m, pc.fill_null(batch.column(1), "").to_pylist(), known)
                out = 1 / (1 + np.exp(-np.clip(m.weights[0] + x @ m.weights[1:], -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(score, "doc_id long, score double"))
    return scored(rows)


def scored(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
