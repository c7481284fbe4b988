"""Files with line breaks in fields, split between tasks, against the one-task scan."""

import random

import pytest
from pyspark.sql import functions as F

from parcelwise.sources import files, layout
from parcelwise.sources.records import records
from parcelwise.sources.scratch import Scratch

rng = random.Random(2)
NAMES = layout.columns_of("order_reviews")


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def review(k, breaks):
    body = rng.choice(["", "fine", '"hi", she said', "a,b", "né 漢字", '""']) + breaks * rng.choice(
        ["\n", "\n\n", "\r\n", 'x"\n"y\n'])
    message = quoted(body) if body else rng.choice(["", '""'])
    return f"r{k},o{k % 7},{rng.randrange(1, 6)},{quoted('t,' + str(k))},{message}," \
           f"2018-01-{k % 28 + 1:02d} 10:00:00,"


@pytest.fixture()
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "1"}
    kept = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_rows_equal_the_one_task_scan(spark, tmp_path, small_splits, ending):
    """Several files and splits, a record longer than two splits, an empty line, no last line
    break, a byte order mark and an empty file."""
    folder = tmp_path / "reviews.csv"
    folder.mkdir()
    rows = [review(k, rng.randrange(3)) for k in range(400)]
    rows[100] = f'r100,o1,5,,"{"long line, " * 3 + ending}{("word" + ending) * 1500}",,'
    parts = [rows[:250], rows[250:390], rows[390:], []]
    for n, part in enumerate(parts):
        text = ending.join([("﻿" if n == 1 else "") + ",".join(NAMES), *part[:2], "", *part[2:]])
        (folder / f"{n}.csv").write_bytes((text + (ending if n % 2 else "")).encode())
    (folder / "none.csv").write_bytes(b"")
    want = sorted(map(str, files.scan_table(spark, str(folder), "order_reviews").collect()))
    got = files.parse_table(spark, str(folder), "order_reviews")
    assert sorted(map(str, got.select(*NAMES).collect())) == want and len(want) == 400
    assert got.where(f"{files.BAD_RECORD} is not null").count() == 0
    assert got.select("_source_uri").distinct().count() == 3

    found = records(spark, str(folder), Scratch(spark, "test").save)
    blocks = {tuple(r) for r in found.select("file", "block").collect()}
    assert len(blocks) > 10 and found.count() == 404
    assert max(len(r["text"]) for r in found.collect()) > 6000


def test_bad_records_and_headers_are_shown(spark, tmp_path, small_splits):
    good = ",".join(NAMES)
    body = "\n".join([good, "r1,o1,5,,,,", "r2,o1,five,,,,", 'r3,o1,1,"x', 'y",,', "r4,o1"])
    (tmp_path / "a.csv").write_text(body)
    (tmp_path / "b.csv").write_text(",".join(NAMES[::-1]) + "\n")
    got = files.parse_table(spark, str(tmp_path), "order_reviews").select(
        "review_id", "review_comment_title", files.BAD_RECORD).collect()
    bad = sorted(r[2] for r in got if r[2] is not None)
    assert bad == sorted([",".join(NAMES[::-1]), "r2,o1,five,,,,", "r4,o1", 'r3,o1,1,"x\ny",,'])
    assert [r[0] for r in got if r[2] is None] == ["r1"]


MONEY = [("12.345678", "12.345678"), ("1", "1"), ("-0.5", "-0.5"), (".25", "0.25"), ("", None),
         ("999999999.999999999", "999999999.999999999"), ("1.5000000000000", "1.5"),
         ("0000000000001.5", "1.5"), ("0E-9", "0"), ("1.5e2", "150")]


@pytest.mark.parametrize("text,value", MONEY)
def test_money_is_not_rounded(spark, tmp_path, text, value):
    from decimal import Decimal
    path = tmp_path / "order_payments.csv"
    path.write_text(",".join(layout.columns_of("order_payments")) + f"\no1,1,boleto,1,{text}\n")
    for df in (files.scan_table(spark, str(path), "order_payments"),
               files.parse_table(spark, str(path), "order_payments")):
        got = df.first()["payment_value"]
        assert got == (None if value is None else Decimal(value))


@pytest.mark.parametrize("text", ["1.2345678901", "1234567890", "x", "1,5", "-", ".", "1 ", "1E-10", "1E9", "E1"])
def test_money_that_would_be_rounded_is_a_verdict(spark, tmp_path, text):
    path = tmp_path / "order_payments.csv"
    path.write_text(",".join(layout.columns_of("order_payments"))
                    + f"\no1,1,boleto,1,{quoted(text)}\n")
    row = files.parse_table(spark, str(path), "order_payments").first()
    assert row["payment_value"] is None and row[files.BAD_RECORD] == f"payment_value={text}"
    with pytest.raises(Exception, match="malformed payment_value"):
        files.scan_table(spark, str(path), "order_payments").select(F.max("payment_value")).collect()
