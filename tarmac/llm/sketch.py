"""Document fingerprints: threshold-scaled sketches (expressions only).

A text's words are its runs of other characters than blanks (0x20, 0x09-0x0D), A-Z in
lower case; its shingles are, for every word, the run of up to ``WORDS`` words that ends
there, so that the first words of a text form shorter runs and no text with words is
without shingles. A shingle's hash is the ``xxhash64`` of its words (missing ones empty). The
sketch keeps every distinct hash below ``2^64 / SCALE``, whatever the size of the text:

* a sketch of a union of texts is the union of their sketches (``merged``);
* as both sides keep the same part of all hashes, the share of one sketch found in another
  estimates containment however unequal the texts are (``containment``), and the share of
  the common hashes in the united ones their likeness (Jaccard; ``likeness``).

The printed fingerprint is ``<shingles>:<md5 of all words>:<sorted hashes>``. Fingerprints
of equal words are equal, and their likeness is 1 even if no hash was kept.

``edited_report`` compares every document with its edited text and with the next document
in the order of doc_id. The order is global, yet one exchange is enough: documents are
dealt to ranges of ids, with the first document of each range also sent to the range
before it, and within a range each row looks one row ahead. The bounds of the ranges come
from a quantile sketch of the ids (``RANGES`` of them per shuffle partition; only they reach
the driver), and a row finds its range by halving over them.

Defined cases: null texts are empty; texts without words have no shingle and likeness 1
among themselves, 0 to others. Rows of one doc_id are put in the order of their texts; a
null doc_id comes after all ids. A table of one row is its own next document. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import stored

WORDS, SCALE = 5, 4
RANGES = 8                    # ranges of ids per shuffle partition

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
GAPS = "\t\n\x0b\f\r"


# ── sketches ──────────────────────────────────────────────────────────


def words(text: Column) -> Column:
    """Words of a text: array of strings."""
    plain = F.translate(text, UPPER + GAPS, UPPER.lower() + " " * len(GAPS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def sketch(text: Column, width: int = WORDS, scale: int = SCALE) -> Column:
    """struct(n: shingles, whole: md5 of all words, hashes: sorted array of kept hashes in hex).
    ``scale`` is at least 2."""
    bound = F.lit((1 << 64) // scale)

    def hashes(padded: Column) -> Column:    # bound once, not computed again for every word
        runs = F.transform(F.slice(padded, F.lit(width), F.size(padded)), lambda _, i: F.xxhash64(
            *(F.get(padded, i + F.lit(k)) for k in range(width))))
        return F.array_sort(F.array_distinct(F.filter(runs, lambda h: (h >= 0) & (h < bound))))

    def of(ws: Column) -> Column:
        padded = F.concat(F.array(*[F.lit("")] * (width - 1)), ws)
        kept = F.transform(F.array(padded), hashes)[0]
        return F.struct(F.size(ws).cast("long").alias("n"),
                        F.md5(F.array_join(ws, " ").cast("binary")).alias("whole"),
                        F.transform(kept, lambda h: F.hex(h)).alias("hashes"))
    return F.transform(F.array(words(F.coalesce(text, F.lit("")))), of)[0]


def printed(s: Column) -> Column:
    """A sketch as a string."""
    return F.concat(s["n"].cast("string"), F.lit(":"), s["whole"], F.lit(":"), F.array_join(s["hashes"], ","))


def parsed(fingerprint: Column) -> Column:
    """The sketch that ``printed`` wrote."""
    part = F.split(fingerprint, ":")
    return F.struct(part[0].cast("long").alias("n"), part[1].alias("whole"),
                    F.when(part[2] == "", F.array().cast("array<string>")).otherwise(F.split(part[2], ","))
                    .alias("hashes"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles in all shingles of two sketches."""
    both = F.size(F.array_intersect(a["hashes"], b["hashes"]))
    every = F.size(a["hashes"]) + F.size(b["hashes"]) - both
    return (F.when(a["whole"] == b["whole"], 1.0).when(every == 0, 0.0)
            .otherwise(both.cast("double") / every.cast("double")))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; null where ``a`` kept none."""
    both = F.size(F.array_intersect(a["hashes"], b["hashes"])).cast("double")
    return F.when(a["whole"] == b["whole"], 1.0).when(F.size(a["hashes"]) > 0, both / F.size(a["hashes"]))


def merged(sketches: DataFrame, key: str, column: str = "sketch") -> DataFrame:
    """(key, hash): the distinct kept hashes of all sketches of a key, a row each. Hashes are
    united before the exchange, and a hot key is as many groups as it has hashes."""
    return sketches.select(key, F.explode(F.col(column)["hashes"]).alias("hash")).distinct()


def containment_in(sketches: DataFrame, unions: DataFrame, key: str, id_col: str,
                   column: str = "sketch") -> DataFrame:
    """(id, key, contained): estimated share of each sketch's shingles in its own key's union of
    ``unions`` (rows of ``merged``, of any corpus). Sketches without a hash have no row."""
    own = sketches.select(id_col, key, F.explode(F.col(column)["hashes"]).alias("hash"))
    found = own.join(unions.withColumn("there", F.lit(1)), [key, "hash"], "left")
    return found.groupBy(id_col, key).agg((F.count("there") / F.count(F.lit(1))).alias("contained"))


# ── every document, its edited text and the next document ─────────────


def id_bounds(ids: DataFrame, n: int) -> list[int]:
    """Up to ``n - 1`` ascending ids that cut the table in parts of about one size."""
    if n < 2:
        return []
    at = [k / n for k in range(1, n)]
    found = ids.agg(F.percentile_approx("doc_id", at, F.lit(10 * n))).first()[0] or []
    return sorted(set(found))


def range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``doc_id`` (null: all), by halving steps over the array."""
    if not bounds:
        return F.lit(0)
    steps, k = [], 1
    while k <= len(bounds):
        steps.insert(0, k)
        k *= 2
    cuts = F.lit(bounds).cast("array<bigint>")
    found = F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), lambda at, step: F.when(
        F.get(cuts, at + step - 1) <= doc_id, at + step).otherwise(at))
    return F.when(doc_id.isNull(), F.lit(len(bounds))).otherwise(found)


def range_heads(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """(range, before, head_id, head_hash): the first row of every range that has rows, and the
    range it follows. As many rows as ranges."""
    ids = rows.select("doc_id", range_of(F.col("doc_id"), bounds).alias("range"), "hash")
    heads = stored(ids.groupBy("range").agg(F.min("doc_id").alias("head_id")), "sketch-heads")
    least = (ids.join(F.broadcast(heads), "range").where(F.col("doc_id").eqNullSafe(F.col("head_id")))
             .groupBy("range").agg(F.min("hash").alias("head_hash")))
    before = F.coalesce(F.lag("range").over(Window.orderBy("range")), F.max("range").over(Window.partitionBy()))
    return heads.join(F.broadcast(least), "range").withColumn("before", before)


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows(doc_id, text, ...)`` and ``next_<column>`` of the row that follows by doc_id (then by
    the text's hash); the first row follows the last."""
    spark = rows.sparkSession
    bounds = id_bounds(rows, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    heads = range_heads(rows, bounds)
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash"))
    own = F.struct(F.col("range"), F.lit(False).alias("guard"))
    guard = F.struct(F.col("before").alias("range"), F.lit(True).alias("guard"))
    dealt = (rows.withColumn("range", range_of(F.col("doc_id"), bounds)).join(F.broadcast(heads), "range")
             .withColumn("to", F.explode(F.when(is_head, F.array(own, guard)).otherwise(F.array(own))))
             .select("to.*", "hash", "doc_id", *columns))
    following = Window.partitionBy("range").orderBy("guard", F.col("doc_id").asc_nulls_last(), "hash")
    return (dealt.select("guard", "doc_id", *columns,
                         *(F.lead(c).over(following).alias(f"next_{c}") for c in columns))
            .where("not guard").drop("guard"))


def edited_report(docs: DataFrame, width: int = WORDS, scale: int = SCALE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    contained_in_next) of every row of ``docs``."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("sketch", sketch(F.col("text"), width, scale))
            .select("doc_id", "text", printed(F.col("sketch")).alias("fingerprint")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    pairs = (with_next(rows, ["text", "fingerprint"])
             .withColumn("n_chars", F.length("text").cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                            F.substring("next_text", F.lit(1), half)))
             .withColumn("of_edited", sketch(F.col("edited"), width, scale))
             .withColumn("own", parsed(F.col("fingerprint")))
             .withColumn("of_next", parsed(F.col("next_fingerprint"))))
    own, of_next = F.col("own"), F.col("of_next")
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint",
        printed(F.col("of_edited")).alias("edited_fingerprint"),
        likeness(own, F.col("of_edited")).alias("near_edited"), likeness(own, of_next).alias("near_next"),
        containment(own, of_next).alias("contained_in_next"))
