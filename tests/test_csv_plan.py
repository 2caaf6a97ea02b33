"""CSV cells are placed once a file and parsed once a row."""

from pyspark.sql import functions as F

from tarmac.sources import csv_landing as cl

HEAD = "FL_DATE,AIRLINE_CODE,ORIGIN,DEST,CRS_DEP_TIME,CRS_ARR_TIME,CRS_ELAPSED_TIME,DISTANCE,DEP_DELAY,ARR_DELAY,flight_id"


def test_places_are_found_once_a_file(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write(f"{HEAD}\n01-02-2024, AA ,JFK,LAX,900.0,x,NA,7.5,,-3,1\n \t\n\"01-02-2024\",\"B\"\"6\",JFK,LAX,1e3,1230,60,7,9.5,1,2\n")
    df = cl.read_raw_csv(spark, tmp_dir, keep_file=False, id_col="flight_id")
    got = [tuple(r[c] for c in ("flight_id", "FL_DATE", "OP_CARRIER", "CRS_DEP_TIME", "CRS_ARR_TIME", "CRS_ELAPSED_TIME",
                                "DISTANCE", "DEP_DELAY", "ARR_DELAY", "_type_errors")) for r in df.orderBy("flight_id").collect()]
    assert got == [("1", "01-02-2024", "AA", 900, None, None, 7.5, None, -3.0, ["CRS_ARR_TIME"]),
                   ("2", "01-02-2024", 'B"6', 1000, 1230, 60.0, 7.0, 9.5, 1.0, [])]
    assert "array_position" not in df._jdf.queryExecution().executedPlan().toString()    # found once a file


def test_blank_lines_and_line_ends(spark):
    values = ["", " \t\r", "\n", " a", "a\r", "a\r\r", "a\rb", None]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(
        cl.is_blank(F.col("v")).alias("new"), (F.trim(F.regexp_replace("v", r"[\t\r]", "")) == "").alias("old"),
        cl.without_cr(F.col("v")).alias("cut"), F.regexp_replace("v", "\r$", "").alias("cut_before"))
    rows = df.collect()
    assert [r["new"] for r in rows] == [r["old"] for r in rows] == [True, True, False, False, False, False, False, None]
    assert [r["cut"] for r in rows] == [r["cut_before"] for r in rows]
