"""CSV extract in batch and as a stream."""

from ventaria.sources.sales_text import COLUMNS, read_raw_csv, stream_raw_csv

HEADER = ",".join(COLUMNS)


def line(i, name='"Bar, ""large"" Ü"'):
    return ",".join([str(i), "O1", "04-Jan-2023", "2023-01-06", "", "C1", "Ann", "corp.", "US", "X", "CA", "9", "West", "P1", "Furniture", "Bookcases", name, "10.5", "2", "0", "-1"])


def write(path, text):
    path.write_bytes(text.encode("utf-8"))
    return str(path)


def test_quotes_crlf_and_text_types(spark, tmp_path):
    path = write(tmp_path / "a.csv", "\r\n".join([HEADER, line(1), line(2, "plain")]) + "\r\n")
    df = read_raw_csv(spark, path)
    assert df.columns[:21] == list(COLUMNS) and {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    rows = {r["row_id"]: r for r in df.collect()}
    assert rows["1"]["product_name"] == 'Bar, "large" Ü' and rows["2"]["profit"] == "-1" and rows["1"]["ship_mode"] is None


def test_line_break_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "b.csv", "\r\n".join([HEADER, line(1, '"two\nlines"')]) + "\r\n")
    assert read_raw_csv(spark, path, multi_line=True).first()["product_name"] == "two\nlines"


def test_broken_record_is_kept(spark, tmp_path):
    path = write(tmp_path / "c.csv", "\r\n".join([HEADER, line(1), "7,short"]) + "\r\n")
    rows = {r["row_id"]: r["_corrupt_record"] for r in read_raw_csv(spark, path).cache().collect()}
    assert rows["7"] == "7,short" and rows["1"] is None


def test_stream_reads_the_same(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in (1, 2, 3):
        write(folder / f"{i}.csv", "\r\n".join([HEADER, line(i)]) + "\r\n")
    query = (stream_raw_csv(spark, str(folder), files_per_batch=1).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["row_id"] for r in got.collect()) == ["1", "2", "3"]
