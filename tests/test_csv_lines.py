import datetime
import random
import warnings

import pytest
from pyspark.sql import functions as F

from punctual.sources import csv_files, csv_lines, date_formats

CELLS = ["", "a", "b c", 'say "hi"', "x,y", "two\nlines", "\n", "é", '""', " end ", "three\n\nlines", "7"]


def written(rng, end):
    def cell():
        text = rng.choice(CELLS)
        if any(c in text for c in ',"\n') or rng.random() < 0.2:
            return '"' + text.replace('"', '""').replace("\n", end) + '"'
        return text

    width = rng.randint(2, 4)
    rows = [",".join(f"c{i}" for i in range(width))]
    for _ in range(rng.randint(0, 12)):
        count = width if rng.random() < 0.9 else rng.randint(2, 5)
        rows.append(",".join([f"r{rng.randrange(10**6)}", *[cell() for _ in range(count - 1)]]))
    return end.join(rows) + (end if rng.random() < 0.7 else "")


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def test_split_reading_equals_one_task(spark, tmp_path):
    """1,000 random files, in folders of files with the same width; 192 bytes a task."""
    rng = random.Random(7)
    folders = {}
    for number in range(1000):
        text = written(rng, "\n" if number % 4 else "\r\n")
        width = text.split("\n")[0].count(",")
        folder = tmp_path / f"w{width}-{number % 4 == 0}"
        folder.mkdir(exist_ok=True)
        folders[folder] = folders.get(folder, 0) + 1
        (folder / f"{number}.csv").write_bytes(text.encode("latin-1"))
    for folder in folders:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "192b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = rows_of(csv_files.read_csv(spark, str(folder)))
        finally:
            for key in ("maxPartitionBytes", "openCostInBytes"):
                spark.conf.unset(f"spark.sql.files.{key}")
        assert got == rows_of(csv_files.read_csv(spark, str(folder), split=False))
    assert sum(folders.values()) == 1000


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    body = "".join(f'{i},"line{chr(10) if i % 2 else " "}{rng.random()}",z\n' for i in range(3000))
    (tmp_path / "one.csv").write_text("id,text,last\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = csv_lines.physical_lines(spark, str(tmp_path), "ISO-8859-1")
        assert lines.select("range").distinct().count() > 5
        out = csv_files.read_csv(spark, str(tmp_path))
        assert out.select(F.spark_partition_id()).distinct().count() > 1
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(int(r["id"]) for r in rows) == list(range(3000))
    assert all(r["text"].startswith("line\n0." if int(r["id"]) % 2 else "line 0.") and r["last"] == "z" for r in rows)


def test_quotes_that_do_not_match_are_read_by_one_task(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('a,b\n5" pipe,1\nx,2\n')
    assert csv_lines.records(spark, str(tmp_path), "ISO-8859-1") is None
    rows = rows_of(csv_files.read_csv(spark, str(tmp_path)))
    assert rows == rows_of(csv_files.read_csv(spark, str(tmp_path), split=False)) and len(rows) == 2


def column(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "d string")


@pytest.mark.parametrize("values, patterns", [
    (["1/31/2018 22:56", "12/1/2017 0:05", None, "no date"], ["M/d/yyyy H:mm"]),
    (["31/1/2018 22:56", "1/12/2017 0:05"], ["d/M/yyyy H:mm"]),
    (["2018-01-31", "2017-12-01"], ["yyyy-M-d"]),
    (["2018-01-31T10:00:00", "2018-01-31 10:00:00", "2018-01-30 10:00:00"],
     ["yyyy-M-d H:mm:ss", "yyyy-M-d'T'H:mm:ss"]),
    (["13/1/2018", "2018-01-31", "2018-02-01"], ["yyyy-M-d", "d/M/yyyy"]),
    (["31.12.2018"], ["d.M.yyyy"]), (["99/99/2018", "x" * 100], []), ([], []),
])
def test_patterns_are_found(spark, values, patterns):
    assert date_formats.infer_patterns(column(spark, *values), ["d"]) == {"d": patterns}


def test_ties_are_reported(spark):
    tied = column(spark, "1/2/2018", "3/4/2018")
    with pytest.raises(ValueError, match="fit .*alike"):
        date_formats.infer_patterns(tied, ["d"])
    assert date_formats.infer_patterns(tied, ["d"], "d/M/yyyy H:mm") == {"d": ["d/M/yyyy"]}
    report = {r["pattern"]: r for r in date_formats.format_report(tied, ["d"]).collect()}
    assert report["M/d/yyyy"]["n_rivals"] == 1 and report["M/d/yyyy"]["possible"]
    assert not report["yyyy/M/d"]["possible"] and report["yyyy/M/d"]["n_shape"] == 2


def test_both_extremes_count(spark):
    """One value after a million could still rule a pattern out."""
    many = spark.range(5000).select(F.lit("1/2/2018").alias("d")).unionAll(column(spark, "13/2/2018"))
    assert date_formats.infer_patterns(many, ["d"]) == {"d": ["d/M/yyyy"]}
    zero = column(spark, "0/2/2018", "1/2/2018")
    assert date_formats.infer_patterns(zero, ["d"]) == {"d": []}


def test_loading_without_a_pattern(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(
        "Order Id,order date (DateOrders),shipping date (DateOrders)\n"
        "1,31/1/2018 5:00,2018-02-03\n2,2018-02-28,2018-02-04\n3,soon,\n")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        rows = csv_files.load_csv(spark, str(tmp_path), date_pattern=None).orderBy("order_id").collect()
    assert [r["order_date"] for r in rows] == [datetime.date(2018, 1, 31), datetime.date(2018, 2, 28), None]
    assert [r["shipping_date"] for r in rows] == [
        datetime.date(2018, 2, 3), datetime.date(2018, 2, 4), None]


def test_the_values_are_read_once_for_a_report(spark, tmp_path):
    """The report is made of the written counts by shape, not of the file again."""
    (tmp_path / "raw.csv").write_text("d,e\n1/31/2018,2018-01-31\n12/1/2017,2017-12-01\n")
    raw = csv_files.read_csv(spark, str(tmp_path))
    report = date_formats.format_report(raw, ["d", "e"])
    assert report.inputFiles() and not any(f.endswith(".csv") for f in report.inputFiles())
    assert {r["column_name"]: r["pattern"] for r in report.filter("possible").collect()} == {
        "d": "M/d/yyyy", "e": "yyyy-M-d"}


def test_records_inside_a_range_are_not_shuffled(spark, tmp_path):
    (tmp_path / "whole.csv").write_text('a,b\n1,"two\nlines"\n2,"and\n\nthree"\n')
    found = csv_lines.records(spark, str(tmp_path), "ISO-8859-1")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["text"] for r in found.collect()) == ['1,"two\nlines"', '2,"and\n\nthree"', "a,b"]
