"""Records with line breaks inside quotes: many byte ranges against the reader of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ventaria.sources.quoted_lines import outcomes, quoted_records
from ventaria.sources.sales_text import COLUMNS, read_quoted_csv, read_raw_csv

PIECES = ["a", "é", ",", "\n", "\r\n", '"', '""', "x" * 40, " ", "\n\n", '",', '\n"', "'"]


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "800b", "spark.sql.files.openCostInBytes": "0b"}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key in keys:
        spark.conf.unset(key)


def hostile(rng, rows, end):
    """Rows with breaks, commas and doubled quotes inside fields, as a writer with minimal quoting makes them."""
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(COLUMNS)
    for i in range(rows):
        writer.writerow([i] + ["".join(rng.choices(PIECES, k=rng.randint(0, 5))) if rng.random() < 0.3 else "v" for _ in COLUMNS[1:]])
    return out.getvalue()


def rows_of(df):
    return sorted(tuple("" if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n")])
def test_equal_to_the_rows_written(spark, tmp_path, small_ranges, seed, end):
    text = hostile(random.Random(seed), 80, end)
    (tmp_path / "a.csv").write_bytes(text.encode())
    (tmp_path / "b.csv").write_bytes(text.replace("x", "y").encode())
    got = read_quoted_csv(spark, str(tmp_path))
    want = [row for t in (text, text.replace("x", "y")) for row in list(csv.reader(io.StringIO(t, newline="")))[1:]]
    assert rows_of(got) == sorted(tuple(r) for r in want)
    assert quoted_records(spark, str(tmp_path)).select("_file", "_block").distinct().count() > 10


def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_ranges):
    """Also stray quotes inside plain fields and text after a closing quote, and a record with too few fields."""
    line = lambda i, name: ",".join([str(i), *["v"] * 15, name, *["1"] * 4])
    names = ['5" pipe', '"two\nlines"', '"a ""b""\nc"', '"x" y', '""', '"\n"', "plain", '"' + "long\n" * 200 + '"', 'it"s,']
    text = "\n".join([",".join(COLUMNS), *[line(i, names[i % len(names)].rstrip(",")) for i in range(90)], "7,short"]) + "\n"
    (tmp_path / "a.csv").write_bytes(text.encode())
    every = lambda df: sorted(tuple(map(str, r)) for r in df.select(*COLUMNS, "_corrupt_record").collect())
    assert every(read_quoted_csv(spark, str(tmp_path))) == every(read_raw_csv(spark, str(tmp_path), multi_line=True).cache())


def test_field_left_open(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_bytes(b'h\n1,"open\n' + b"2,x\n" * 300)
    (tmp_path / "b.csv").write_bytes(b"h\n3,x\n")
    got = sorted(r["record"] for r in quoted_records(spark, str(tmp_path)).collect())
    assert got == sorted(["h", '1,"open\n' + "\n".join(["2,x"] * 300), "h", "3,x"])


def test_empty_files_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"")
    assert quoted_records(spark, str(tmp_path)).isEmpty()
    (tmp_path / "b.csv").write_bytes(b"h\r\n\r\n  \n1\r\n")
    assert sorted(r["record"] for r in quoted_records(spark, str(tmp_path)).collect()) == ["1", "h"]


@pytest.mark.parametrize("line, outside, inside", [
    ("a,b", False, True), ('a,"b', True, False), ('"a', True, False), ('a"', False, False), ('","', False, True),
    ('""', False, True), ('"""', True, False), ("", False, True), ('a,5" x', False, False), ('x","y', True, True)])
def test_outcomes_of_a_line(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "v string").select(*[c.alias(n) for n, c in zip(("o", "i"), outcomes(F.col("v")))]).first()
    assert (row["o"], row["i"]) == (outside, inside)


def test_long_lines(spark):
    df = spark.range(1).select(F.concat(F.lit('"'), F.repeat(F.lit('""'), 200000), F.repeat(F.lit(',"x"'), 50000)).alias("v"))
    assert df.select(*[c.alias(n) for n, c in zip(("o", "i"), outcomes(F.col("v")))]).first() is not None
