"""The CSV reader on awkward files."""

import os
from datetime import datetime
from decimal import Decimal

import pandas
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from comparing import rows
from parcelhouse import queries
from parcelhouse.sources.csv_files import (
    CsvTables, header, long_records, plain_records, raw_table, spans_lines,
)
from parcelhouse.sources.driver_tables import RawTables

REVIEW_HEADER = (
    "review_id,order_id,review_score,review_comment_title,review_comment_message,"
    "review_creation_date,review_answer_timestamp\n"
)
PRODUCT_HEADER = (
    "product_id,product_category_name,product_name_lenght,product_description_lenght,"
    "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
)


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_multiline_text_with_quotes(spark, tmp_path):
    text = (
        REVIEW_HEADER
        + 'r1,o1,5,"a ""quoted"" title","line one\nline two, with comma\n\nlast",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
        + 'r2,o2,1,,,2018-01-19 00:00:00,\n'
        + 'r3,o3,4,"","two\r\nlines",2018-01-20 00:00:00,2018-01-21 00:00:00\n'
    )
    df = raw_table(spark, "order_reviews", write(tmp_path, "a.csv", text))
    got = {r["review_id"]: r for r in df.collect()}
    assert got["r1"]["review_comment_title"] == 'a "quoted" title'
    assert got["r1"]["review_comment_message"] == "line one\nline two, with comma\n\nlast"
    assert got["r1"]["review_answer_timestamp"] == datetime(2018, 1, 18, 21, 46, 59)
    assert got["r2"]["review_comment_title"] is None
    assert got["r2"]["review_answer_timestamp"] is None
    assert got["r3"]["review_comment_title"] is None
    assert got["r3"]["review_comment_message"] == "two\r\nlines"


def test_crlf_file(spark, tmp_path):
    text = (REVIEW_HEADER + 'r1,o1,5,t,"a\nb",2018-01-18 00:00:00,2018-01-19 00:00:00\n'
            'r2,o2,5,t,m,2018-01-18 00:00:00,2018-01-19 00:00:00\n').replace("\n", "\r\n")
    df = raw_table(spark, "order_reviews", write(tmp_path, "a.csv", text))
    moment = datetime(2018, 1, 19)
    assert rows(df, "review_id", "review_comment_message", "review_answer_timestamp") == {
        ("r1", "a\r\nb", moment), ("r2", "m", moment)}


@pytest.mark.parametrize("split", ["7", "64", "1000"])
def test_records_across_splits(spark, tmp_path, split):
    """The same records come out however the file is cut."""
    expected = set()
    text = "id,text\n"
    for i in range(300):
        body = f'{"x" * (i % 17)}\n"{i}"\n' * (i % 4) + "end"
        expected.add((str(i), body))
        quoted = body.replace('"', '""')
        text += f'{i},"{quoted}"\n'
    path = write(tmp_path, "a.csv", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        assert rows(long_records(spark, path)) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


AWKWARD = (
    'id,text,more\n1,12" tv,x\n2,"a\nb, ""c""\n",5"\n3,,"\n"\n4,say "hi",""\n5,"",a "b" c"\n'
    '6,"""",""\n7,"""\n""","one"\n8,6\' 2",end\n'
)


@pytest.mark.parametrize("split", ["7", "64", "1000"])
def test_quotes_open_a_text_at_field_starts_only(spark, tmp_path, split):
    path = write(tmp_path, "a.csv", AWKWARD + "".join(f'{i},{i}" x,"{i}\n"\n' for i in range(9, 80)))
    expected = pandas.read_csv(path, dtype=str, keep_default_na=False)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {(r["id"], r["text"] or "", r["more"] or "") for r in long_records(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == set(expected.itertuples(index=False, name=None))


def test_line_breaks_in_other_tables(spark, tmp_path):
    text = 'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,1,"a\nb",SP\ns2,2,5" c,RJ\n'
    path = write(tmp_path, "s.csv", text)
    assert spans_lines(spark, path)
    assert rows(raw_table(spark, "sellers", path), "seller_id", "seller_city") == {
        ("s1", "a\nb"), ("s2", '5" c')}


def test_stray_quotes_without_line_breaks_stay_plain(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,text\n1,12" tv\n2,"a ""b"""\n3,"x"\n')
    assert not spans_lines(spark, path)
    assert rows(plain_records(spark, path)) == {("1", '12" tv'), ("2", 'a "b"'), ("3", "x")}


def test_quote_never_closed_is_an_error(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,text\n1,"open\n' + "2,line\n" * 500)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        with pytest.raises(PySparkException, match="never closed"):
            long_records(spark, path, most_characters=1000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_record_over_many_splits(spark, tmp_path):
    """A record of a few hundred splits is put together; one beyond the limit is refused."""
    text = "\n".join(f'line {k}, with ""quotes""' for k in range(20_000))
    path = tmp_path / "order_reviews_dataset.csv"
    path.write_text(f'a,b\n1,"{text}"\n2,short\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = {r["a"]: r["b"] for r in long_records(spark, str(path)).collect()}
        assert found == {"1": text.replace('""', '"'), "2": "short"}
        with pytest.raises(Exception, match="never closed"):
            long_records(spark, str(path), most_characters=100_000).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_very_long_line_of_quotes(spark, tmp_path):
    body = 'ab""' * 300_000
    path = write(tmp_path, "a.csv", f'id,text\n1,"{body}\nend"\n2,y\n')
    got = dict(rows(long_records(spark, path)))
    assert got["1"] == 'ab"' * 300_000 + "\nend" and got["2"] == "y"


def test_several_files_each_with_header(spark, tmp_path):
    write(tmp_path, "part-1.csv", 'id,text\n1,"a\nb"\n')
    write(tmp_path, "part-2.csv", 'id,text\n2,"c"\n3,d\n')
    assert rows(long_records(spark, str(tmp_path))) == {("1", "a\nb"), ("2", "c"), ("3", "d")}


def test_files_with_other_columns_are_an_error(spark, tmp_path):
    write(tmp_path, "part-1.csv", "id,text\n1,a\n")
    write(tmp_path, "part-2.csv", "text,id\nb,2\n")
    with pytest.raises(Exception, match="other columns than in the first file"):
        long_records(spark, str(tmp_path)).collect()


def test_byte_order_mark_of_long_records(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,text\n1,"a\nb"\n', "utf-8-sig")
    assert rows(long_records(spark, path)) == {("1", "a\nb")}


def test_byte_order_mark(spark, tmp_path):
    path = write(tmp_path, "t.csv", "product_category_name,product_category_name_english\n"
                 "beleza_saude,health_beauty\n", "utf-8-sig")
    assert header(spark, path)[0] == "product_category_name"
    df = raw_table(spark, "category_translation", path)
    assert rows(df) == {("beleza_saude", "health_beauty")}


def test_integers_with_decimals_and_missing_values(spark, tmp_path):
    path = write(tmp_path, "p.csv", PRODUCT_HEADER + "p1,perfumaria,40.0,287.0,1.0,225,16,10,14\n"
                 "p2,,,,,,,,\np3,NaN,NA,null,\\N,1.5,2,3,4\n")
    df = raw_table(spark, "products", path)
    got = {r["product_id"]: r for r in df.collect()}
    assert got["p1"]["product_name_length"] == 40
    assert got["p1"]["product_weight_g"] == Decimal("225.00")
    assert got["p2"]["product_photos_qty"] is None
    assert got["p3"]["product_category_name"] is None
    assert got["p3"]["product_description_length"] is None
    assert df.schema["product_name_length"].dataType.simpleString() == "int"


@pytest.mark.parametrize("number", ["40.5", "40.00001", "0.000000000000000000000000001", "4.000001e1", "45e-1", "1E-30", "0.5e0"])
def test_fraction_in_integer_column_is_an_error(spark, tmp_path, number):
    path = write(tmp_path, "p.csv", PRODUCT_HEADER + f"p1,perfumaria,{number},1,1,1,1,1,1\n")
    with pytest.raises(PySparkException, match="not a whole number"):
        raw_table(spark, "products", path).collect()


@pytest.mark.parametrize("number,value", [("4e1", 40), ("4000e-2", 40), ("4.0E+1", 40), ("0e-5", 0), ("0.0", 0)])
def test_whole_numbers_with_exponents(spark, tmp_path, number, value):
    path = write(tmp_path, "p.csv", PRODUCT_HEADER + f"p1,perfumaria,{number},1,1,1,1,1,1\n")
    assert rows(raw_table(spark, "products", path), "product_name_length") == {(value,)}


def test_unreadable_moment_is_missing(spark, tmp_path):
    path = write(
        tmp_path, "o.csv",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o1,c1,delivered,2017-10-02 10:56:33,soon,2017-13-45 00:00:00,,2017-10-18 00:00:00\n")
    row = raw_table(spark, "orders", path).first()
    assert row["order_purchase_timestamp"] == datetime(2017, 10, 2, 10, 56, 33)
    assert row["order_approved_at"] is None
    assert row["order_delivered_carrier_date"] is None
    assert row["order_estimated_delivery_date"] == datetime(2017, 10, 18)


def test_columns_by_name_not_place(spark, tmp_path):
    path = write(tmp_path, "s.csv", "seller_state,extra,seller_city,seller_id,seller_zip_code_prefix\n"
                 "SP,x,campinas,s1,01323\n")
    assert rows(raw_table(spark, "sellers", path)) == {("s1", 1323, "campinas", "SP")}


def test_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path, "s.csv", "seller_id,seller_city,seller_state\ns1,campinas,SP\n")
    with pytest.raises(PySparkException, match="seller_zip_code_prefix"):
        raw_table(spark, "sellers", path)


def test_record_that_does_not_fit_is_an_error(spark, tmp_path):
    path = write(tmp_path, "s.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
                 "s1,1,a\n")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        raw_table(spark, "sellers", path).collect()


@pytest.mark.parametrize("name,head", [("products", PRODUCT_HEADER), ("order_reviews", REVIEW_HEADER)])
def test_header_only(spark, tmp_path, name, head):
    assert raw_table(spark, name, write(tmp_path, "a.csv", head)).count() == 0


def test_files_found_by_pattern(spark, tmp_path):
    write(tmp_path, "shop_orders_dataset.csv", "a\n")
    write(tmp_path, "shop_sellers_dataset.csv",
          "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,9,a,SP\n")
    assert CsvTables(spark, str(tmp_path))["sellers"].count() == 1


def test_points_get_distinct_ids(spark, tmp_path):
    lines = "".join(f"{i % 3},-23.5456212811527,-46.6392920480017,sao paulo,SP\n" for i in range(50))
    path = write(tmp_path, "g.csv", "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                 "geolocation_city,geolocation_state\n" + lines)
    df = raw_table(spark, "geolocation", path)
    assert df.select(F.countDistinct("geolocation_id")).first()[0] == 50
    assert df.first()["geolocation_lat"] == Decimal("-23.5456213")


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_records_across_runs_of_lines(spark, tmp_path, monkeypatch, bits):
    """Lines are judged in short runs, wherever a text begins and ends."""
    monkeypatch.setattr("parcelhouse.sources.csv_files.RUN_BITS", bits)
    texts = [f'"{"x" * n}\n""{n}"",\n\nend"' if n % 3 else f"plain {n}" for n in range(40)]
    body = "".join(f"r{n},o{n},5,t,{t},,\n" for n, t in enumerate(texts))
    df = long_records(spark, write(tmp_path, "a.csv", REVIEW_HEADER + body))
    expected = {
        (f"r{n}", f'{"x" * n}\n"{n}",\n\nend' if n % 3 else f"plain {n}") for n in range(40)}
    assert rows(df, "review_id", "review_comment_message") == expected
    partitions = df._jdf.queryExecution().optimizedPlan().toString()
    assert "shiftright" in partitions or ">>" in partitions


def test_files_of_one_table_at_a_time(spark, small, monkeypatch):
    """What was written and read is gone before the next table is written."""
    monkeypatch.setattr(queries, "BROKEN_TEXTS", {
        "sellers": "seller_city", "category_translation": "product_category_name_english"})
    folders, lying, write = [], [], queries.write_csv

    def written(tables, folder, names):
        lying.append([f for f in folders if os.path.exists(f.removeprefix("file:"))])
        folders.append(write(tables, folder, names))
        return folders[-1]

    monkeypatch.setattr(queries, "write_csv", written)
    found = rows(queries.load_csv_quoted_line_breaks(spark, small))
    assert lying == [[], []] and not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    raw, tail = RawTables(spark, small), '\n"x", y'
    assert found == {("sellers", r["seller_city"] + tail, r["count"])
                     for r in raw["sellers"].groupBy("seller_city").count().collect()} | {
        ("category_translation", r[0] + tail, 1)
        for r in raw["category_translation"].select("product_category_name_english").collect()}
