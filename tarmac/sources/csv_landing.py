"""Raw CSV ingestion (header, all matching files, typed by name).

Files are read as lines and each file's columns are found by its own header, so
other column orders, further columns and the ``AIRLINE_CODE`` spelling are
accepted side by side. A value that does not parse becomes NULL and is counted
by the quality report instead of failing the job. No schema inference pass.

Quoted cells may hold line breaks (``joined_records``): lines are joined to records
without any file in one task, whatever block of the file they were read from.
Lines that hold nothing but white space are skipped, inside a quoted cell they
belong to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schema import COLUMN_ALIASES, RAW_SCHEMA
from tarmac.session import scratch_path

NUMERIC_TYPES = (T.DoubleType, T.FloatType)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename alias spellings to canonical names when present."""
    present = {k: v for k, v in COLUMN_ALIASES.items() if k in df.columns}
    clash = [v for v in present.values() if v in df.columns]
    if clash:
        raise ValueError(f"both alias and canonical column present: {clash}")
    return df.withColumnsRenamed(present) if present else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN → NULL on floating columns (Spark orders NaN above every number)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    if not cols:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols})


# ── fixed values: spellings of a missing value in the original reader ──
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
           "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ───────────────────────────────────────────────────────────────────────


def with_file_columns(lines: DataFrame) -> DataFrame:
    """Lines of a text source with the file and place they come from."""
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_line"))


def is_blank(value: Column) -> Column:
    """No character but blanks, tabs and carriage returns."""
    return ~F.rlike(value, F.lit(r"[^ \t\r]"))


def without_cr(value: Column) -> Column:
    return F.when(F.contains(value, F.lit("\r")), F.regexp_replace(value, "\r$", "")).otherwise(value)


# ── records ──────────────────────────────────────────────────────────
# A cell that starts with a quote goes on to the closing quote ("" stands for one); a quote
# elsewhere in a cell is a character like any other.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
OPENS = f'^(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}$'      # ends inside a quoted cell
STAYS = f'^{_INSIDE}$'                                                # no closing quote in it
CLOSES = f'^{_INSIDE}"[^,]*+,?'                                       # up to the end of the open cell


def line_effect(value: Column) -> tuple[Column, Column]:
    """Is the end of a line inside a quoted cell, if its start is outside one; and if inside."""
    quotes = F.contains(value, F.lit('"'))
    outside = F.when(quotes, F.rlike(value, F.lit(OPENS))).otherwise(False)
    inside = F.when(quotes, F.rlike(value, F.lit(STAYS)) | F.rlike(
        F.regexp_replace(value, CLOSES, ""), F.lit(OPENS))).otherwise(True)
    return outside, inside


def _states_before(rows: DataFrame, window) -> DataFrame:
    """Adds ``_fixed`` and ``_odd``: the state before a row is ``_fixed`` (null: that before the
    first row of its window), changed into the other if ``_odd``. A row with equal effects
    fixes the state, one with crossed effects changes it, any other leaves it."""
    crossed = F.col("_outside") & ~F.col("_inside")
    rows = rows.withColumn("_flips", F.sum(crossed.cast("long")).over(
        window.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("_outside") == F.col("_inside"), F.struct(
        F.col("_outside").alias("state"), F.col("_flips").alias("flips"))), ignorenulls=True).over(before)
    rows = rows.withColumn("_last", last).withColumn("_seen", F.coalesce(F.max("_flips").over(before), F.lit(0)))
    return (rows.withColumn("_fixed", F.col("_last.state"))
            .withColumn("_odd", (F.col("_seen") - F.coalesce("_last.flips", F.lit(0))) % 2 == 1)
            .drop("_flips", "_last", "_seen"))


def _state(start: Column, fixed: Column, odd: Column) -> Column:
    return F.coalesce(fixed, start) != odd


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_records(lines: DataFrame) -> DataFrame:
    """(value, source_file): the lines of files with line breaks in quoted cells, joined to
    records (each break comes back as ``\\n``), without blank lines between records.

    What a line does to the state "inside a quoted cell" is a function of the state before
    it, and such functions compose: over the lines of a block, then over one row per block of
    a file. So every line's state follows without reading a file in order. A record is keyed
    by the block and line it began in. No group is larger than a block, or one record.
    """
    outside, inside = line_effect(F.col("value"))
    block = ["source_file", "_block"]
    in_block, in_file = Window.partitionBy(*block).orderBy("_line"), Window.partitionBy("source_file").orderBy("_block")
    placed = _written(_states_before(lines.withColumn("_outside", outside).withColumn("_inside", inside), in_block),
                      "csv-lines")
    # a row per block: the effects of all its lines, then the state it starts with
    behind = [_state(_state(F.lit(at), F.col("_fixed"), F.col("_odd")), F.when(
        F.col("_outside") == F.col("_inside"), F.col("_outside")), F.col("_outside") & ~F.col("_inside"))
        for at in (False, True)]
    effects = (placed.withColumn("_ends", F.struct(behind[0].alias("o"), behind[1].alias("i")))
               .groupBy(*block).agg(F.max_by("_ends", "_line").alias("_ends"))
               .select(*block, F.col("_ends.o").alias("_outside"), F.col("_ends.i").alias("_inside")))
    starts = _states_before(effects, in_file).select(
        *block, _state(F.lit(False), F.col("_fixed"), F.col("_odd")).alias("_start"))
    blocks = _written(starts, "csv-blocks")
    lines = placed.join(blocks, block).withColumn("_open", _state(F.col("_start"), F.col("_fixed"), F.col("_odd")))
    lines = lines.where(F.col("_open") | ~is_blank(F.col("value")))
    first = F.when(~F.col("_open"), F.col("_line"))
    # lines ahead of a block's first record belong to the last record of the blocks before
    last = lines.groupBy(*block).agg(F.max(first).alias("_last"))
    carry = _written(last.select(*block, F.last(F.when(F.col("_last").isNotNull(), F.struct("_block", "_last")), True)
                                 .over(in_file.rowsBetween(Window.unboundedPreceding, -1)).alias("_from")), "csv-carry")
    own = F.last(first, True).over(in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    keyed = (lines.withColumn("_first", own).join(carry, block)
             .withColumn("_key", F.when(F.col("_first").isNotNull(), F.struct("_block", F.col("_first").alias("_last")))
                         .otherwise(F.col("_from"))))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_line", without_cr(F.col("value")).alias("text"))))
    return (keyed.groupBy("source_file", "_key").agg(parts.alias("_parts"))
            .select(F.array_join(F.col("_parts.text"), "\n").alias("value"), "source_file"))


def rows_by_header(lines: DataFrame, extra: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV lines: every file's columns are found by that file's own header.

    ``rows`` has the raw columns as text (alias spellings accepted, order and further columns
    of a file don't matter), ``extra`` columns where a file has them, and ``source_file``.
    A file whose header lacks a required column goes to ``rejected`` (source_file, missing)
    as a whole; the others are read. The header is the first line of a file that isn't blank;
    blank lines are no rows. Files in which a quoted cell goes on behind the end of a line
    take the way of ``joined_records``, all others one scan.
    """
    blank = is_blank(F.col("value"))
    heads = (lines.where(~blank).withColumn("_opens", line_effect(F.col("value"))[0])
             .groupBy("source_file").agg(F.max("_opens").alias("_opens"), F.min(F.when(
                 F.col("_block") == 0, F.struct("_line", "value"))).alias("_first"))
             .select("source_file", "_opens", F.col("_first.value").alias("_header")))
    names = F.transform(F.split(F.regexp_replace("_header", "\r$", ""), ","),
                        lambda x: F.trim(F.regexp_replace(x, '^\ufeff|"', "")))
    heads = heads.withColumn("_names", names)
    wanted = [f.name for f in RAW_SCHEMA.fields]
    spelled = {v: k for k, v in COLUMN_ALIASES.items()}

    def place(name: str) -> Column:
        at = F.array_position("_names", name)
        return F.when(at == 0, F.array_position("_names", spelled[name])).otherwise(at) if name in spelled else at

    missing = F.array_compact(F.array(*[F.when(place(c) == 0, F.lit(c)) for c in wanted]))
    at = [place(c) for c in wanted] + [F.array_position("_names", c) for c in extra or []]
    places = F.array(*[F.when(a > 0, a.cast("int")) for a in at])
    heads = heads.select("source_file", "_opens", "_header", places.alias("_places"),
                         missing.alias("_missing")).checkpoint(eager=True)     # one row per file
    n_files = heads.count()
    good = heads.where(F.size("_missing") == 0).drop("_missing")
    n_joined = good.where("_opens").count()
    if n_files <= 10_000:
        good = F.broadcast(good)
    rows = (lines.join(good, "source_file").where(~F.col("_opens") & ~blank & (F.col("value") != F.col("_header")))
            .withColumn("value", without_cr(F.col("value"))))
    if n_joined:
        cut = [F.col(c) for c in ("value", "source_file", "_block", "_line")]
        joined = joined_records(lines.join(good.where("_opens"), "source_file").select(*cut)).join(good, "source_file")
        rows = rows.select("value", "source_file", "_opens", "_header", "_places").unionByName(
            joined.where(F.col("value") != F.regexp_replace("_header", "\r$", ""))
            .select("value", "source_file", "_opens", "_header", "_places"))
    # the CSV parser allocates a buffer per line, so cells are cut by pattern
    plain = F.split("value", ",")
    quoted = F.transform(
        F.regexp_extract_all("value", F.lit(f'("{_INSIDE}"|[^,]*)(?:,|$)'), 1),
        lambda c: F.when(F.startswith(c, F.lit('"')), F.replace(
            F.substr(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    rows = rows.withColumn("_cells", F.when(F.contains("value", F.lit('"')), quoted).otherwise(plain))
    # one expression for all columns: written out for each, they make a method too long to be compiled
    texts = F.transform("_places", lambda at: F.trim(F.try_element_at(F.col("_cells"), at)))
    rows = rows.withColumn("_texts", F.transform(texts, lambda x: F.when(~x.isin(MISSING), x)))
    out = rows.select(*[F.get("_texts", F.lit(i)).alias(c) for i, c in enumerate(wanted + (extra or []))], "source_file")
    rejected = heads.where(F.size("_missing") > 0).select("source_file", F.col("_missing").alias("missing"))
    return out, rejected


def typed_value(text: Column, number: Column, kind: T.DataType) -> Column:
    """Text → number or NULL. Whole numbers may be written with a fraction of zero (``900.0``)."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number.cast(kind)
    if isinstance(kind, T.IntegralType):
        return F.when(number == F.floor(number), F.floor(number)).try_cast(kind)
    return text.try_cast(kind)


def type_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw text columns → typed columns; ``_type_errors`` lists columns whose text didn't parse.
    Parsed, typed and checked in steps, so a text is parsed once."""
    kinds = {f.name: f.dataType for f in RAW_SCHEMA.fields if not isinstance(f.dataType, T.StringType)}
    df = df.withColumns({f"_number_{c}": F.col(c).try_cast("double") for c in kinds})
    df = df.withColumns({f"_typed_{c}": typed_value(F.col(c), F.col(f"_number_{c}"), kind) for c, kind in kinds.items()})
    errors = [F.when(F.col(c).isNotNull() & F.col(f"_typed_{c}").isNull(), F.lit(c)) for c in kinds]
    return nan_to_null(df.select(
        *[F.col(c) for c in keep or []],
        *[F.col(f"_typed_{f.name}" if f.name in kinds else f.name).alias(f.name) for f in RAW_SCHEMA.fields],
        F.array_compact(F.array(*errors)).alias("_type_errors")))


def read_raw_csv(spark: SparkSession, path: str, keep_file: bool = True, glob: str = "*.csv",
                 id_col: str | None = None) -> DataFrame:
    """Read every CSV file under ``path`` by its own header (see ``rows_by_header``) and type the
    raw columns. Adds ``_type_errors`` and, if ``keep_file``, ``source_file``. A file without
    a required column is an error."""
    lines = (spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path))
    rows, rejected = rows_by_header(with_file_columns(lines), [id_col] if id_col else None)
    bad = rejected.limit(3).collect()
    if bad:
        raise ValueError(f"files without required columns: {[(r['source_file'], r['missing']) for r in bad]}")
    return type_rows(rows, ([id_col] if id_col else []) + (["source_file"] if keep_file else []))
