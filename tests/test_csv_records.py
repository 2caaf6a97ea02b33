"""Records of CSV files: quoted line breaks, blank lines, line ends, whatever the blocks of a file."""

import csv
import io
import os
import random

import pytest

from tarmac.schema import RAW_SCHEMA
from tarmac.sources import csv_landing as cl
from tarmac.streaming import landing as lx

COLS = [f.name for f in RAW_SCHEMA.fields]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def plain(text):
    """Cells of all records by the standard reader, blank lines between records left out."""
    return [r for r in csv.reader(io.StringIO(text)) if len(r) > 1 or (r and r[0].strip())]


def random_cell(rng):
    kind = rng.randrange(7)
    word = "".join(rng.choice("abc xyz") for _ in range(rng.randint(0, 8))).strip()
    if kind < 3:
        return word
    if kind == 3:
        return f'{word}5" x'                                     # a quote inside an unquoted cell
    inner = "".join(rng.choice(["a", "b", ",", "\n", '""', "\n\n", " ", "long words "]) for _ in range(rng.randint(0, 9)))
    return f'"{inner}"'


def random_file(rng, rows, end="\n"):
    out = ["c0,c1,c2"]
    for _ in range(rows):
        out.append(",".join(random_cell(rng) for _ in range(3)))
        if rng.random() < 0.2:
            out.append(rng.choice(["", "   ", "\t"]))
    return end.join(out) + end * rng.randrange(3)


@pytest.mark.parametrize("block", [64, 1000, 1 << 20])
def test_records_equal_the_standard_reader(spark, tmp_dir, block):
    rng = random.Random(block)
    texts = {f"f{k}.csv": random_file(rng, 150 if block > 64 else 40) for k in range(4)}
    for name, text in texts.items():
        write(f"{tmp_dir}/in/{name}", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        lines = cl.with_file_columns(spark.read.text(f"{tmp_dir}/in"))
        got = {}
        for r in cl.joined_records(lines).collect():
            got.setdefault(os.path.basename(r["source_file"]), []).append(r["value"])
        assert block > 64 or lines.select("_block").distinct().count() > 10
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, text in texts.items():
        cells = [next(csv.reader(io.StringIO(v))) for v in got[name]]
        assert sorted(map(tuple, cells)) == sorted(tuple(r) for r in plain(text))


def flight(day, note):
    cells = {"FL_DATE": f"{day:02d}-02-2024", "OP_CARRIER": "AA", "ORIGIN": "JFK", "DEST": "LAX", "CRS_DEP_TIME": "900",
             "CRS_ARR_TIME": "1100", "CRS_ELAPSED_TIME": "120", "DISTANCE": "1000", "DEP_DELAY": "1", "ARR_DELAY": "20"}
    return f"{day}," + '"' + note.replace('"', '""') + '",' + ",".join(cells[c] for c in COLS)


NOTES = ["plain", "two\nlines", 'he said "no",\n\nthen left', "\n", "a,b", '"', "x" * 30_000 + "\n" + "y" * 30_000]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_flights_with_line_breaks_in_notes(spark, tmp_dir, end):
    head = ",".join(["flight_id", "NOTE", *COLS])
    rows = [flight(k + 1, n) for k, n in enumerate(NOTES)]
    write(f"{tmp_dir}/in/data/raw/a.csv", end + head + end + end.join(rows) + end + "  " + end + end)
    write(f"{tmp_dir}/in/data/raw/b.csv", head + end + flight(20, "one") + end + end)
    df = cl.read_raw_csv(spark, f"{tmp_dir}/in", id_col="flight_id")
    want = sorted([*range(1, len(NOTES) + 1), 20])
    got = df.collect()
    assert sorted(int(r["flight_id"]) for r in got) == want
    assert {(r["OP_CARRIER"], r["CRS_DEP_TIME"], r["ARR_DELAY"], tuple(r["_type_errors"])) for r in got} == \
        {("AA", 900, 20.0, ())}
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    out = spark.read.parquet(f"{tmp_dir}/out/labelled")
    assert sorted(r["flight_id"] for r in out.collect()) == want
    assert spark.read.parquet(f"{tmp_dir}/out/quarantine").count() == 0


def test_files_without_quoted_line_breaks_are_not_shuffled(spark, tmp_dir):
    write(f"{tmp_dir}/in/a.csv", ",".join(COLS) + "\n\n" + flight(3, "x").split(",", 2)[2] + "\n \n")
    lines = cl.with_file_columns(spark.read.text(f"{tmp_dir}/in"))
    rows, _ = cl.rows_by_header(lines)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan
    assert rows.count() == 1
