import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockflow.fixed_values import ANSWERS, DEFAULT_ANSWER
from stockflow.functions import numbers, text, timestamps


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ("2025-05-28T15:00:00Z", dt.datetime(2025, 5, 28, 15)),
        ("2025-05-28 15:00:00", None),
        ("2025-13-28T15:00:00Z", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_iso(spark, value, expected):
    assert one(spark, value, "string", timestamps.parse_iso) == expected


@pytest.mark.parametrize(
    "value",
    ["2025-05-28T15:00:00Z", "2025-05-28 15:00:00", "2025-05-28T15:00:00"],
)
def test_parse_lenient(spark, value):
    assert one(spark, value, "string", timestamps.parse_lenient) == dt.datetime(2025, 5, 28, 15)


def test_parse_lenient_gives_null_on_garbage(spark):
    assert one(spark, "soon", "string", timestamps.parse_lenient) is None


def test_render_and_days(spark):
    ts = dt.datetime(2024, 2, 28, 23, 0)
    moved = one(spark, ts, "timestamp", lambda c: timestamps.render(timestamps.plus_days(c, 2)))
    assert moved == "2024-03-01 23:00:00"


@pytest.mark.parametrize(
    ("value", "kind", "target", "expected"),
    [
        ("12.5", "string", "double", 12.5),
        ("12.7", "string", "bigint", 12),
        ("abc", "string", "double", 0.0),
        (None, "string", "double", 0.0),
        (float("nan"), "double", "double", 0.0),
        (2**62 + 1, "bigint", "bigint", 2**62 + 1),
    ],
)
def test_to_number(spark, value, kind, target, expected):
    assert one(spark, value, kind, lambda c: numbers.to_number(c, target)) == expected


@pytest.mark.parametrize(
    ("blob", "expected"),
    [
        (b"\x01\x00\x00", 1),
        (b"", 0),
        (None, None),
        ((2**63 - 1).to_bytes(8, "little"), 2**63 - 1),
        ((2**64 - 1).to_bytes(8, "little"), None),
        (b"\x05" + b"\x00" * 11, 5),
        (b"\x05" + b"\x00" * 10 + b"\x01", None),
        ((123456789012).to_bytes(6, "little"), 123456789012),
    ],
)
def test_decode_little_endian(spark, blob, expected):
    value = bytearray(blob) if blob is not None else None
    assert one(spark, value, "binary", numbers.decode_little_endian) == expected


def test_encode_little_endian(spark):
    for value in (0, 1, 255, 256, 2**40 + 3):
        stored = one(spark, value, "bigint", numbers.encode_little_endian)
        assert bytes(stored) == value.to_bytes(8, "little")


@pytest.mark.parametrize(
    ("value", "expected"),
    [(12.0, "12.0"), (20000000.0, "20000000.0"), (0.25, "0.25"), (-3.0, "-3.0"), (None, None)],
)
def test_float_text(spark, value, expected):
    assert one(spark, value, "double", numbers.float_text) == expected


def test_clean_text(spark):
    for value, expected in [("nan", ""), (None, ""), ("x", "x")]:
        assert one(spark, value, "string", text.clean_text) == expected


@pytest.mark.parametrize(
    ("description", "predicted", "actual"),
    [
        ("Predicted Quantity: 69.0, Actual Quantity: 30", "69.0", "30.0"),
        ("Predicted Quantity: 69.5, Actual Quantity: N/A", "69.5", "N/A"),
        ("Predicted Quantity: -4.0, Z-Score: 2.00", "N/A", "N/A"),
        ("nothing here", "N/A", "N/A"),
    ],
)
def test_described_quantity(spark, description, predicted, actual):
    found = [
        one(spark, description, "string", lambda c, w=which: text.described_quantity(c, w))
        for which in ("predicted", "actual")
    ]
    assert found == [predicted, actual]


@pytest.mark.parametrize(
    ("message", "expected"),
    [("a\nCategory: Toys\nb", "Toys"), ("Category: Toys", None), ("no", None), (None, None)],
)
def test_category_in_text(spark, message, expected):
    assert one(spark, message, "string", text.category_in_text) == expected


@pytest.mark.parametrize(
    ("question", "spot"),
    [
        ("Is this PRICE an inventory issue?", 0),
        ("why this Price and quantity", 1),
        ("what QUANTITY", 2),
        ("the next steps?", 3),
        ("hello", None),
    ],
)
def test_answer_for(spark, question, spot):
    expected = DEFAULT_ANSWER if spot is None else ANSWERS[spot][1]
    assert one(spark, question, "string", text.answer_for) == expected


def test_batch_number(spark):
    cases = [("P001-B12", 12), ("P001", None), ("B7x", None), ("B3", 3)]
    for value, expected in cases:
        assert one(spark, value, "string", text.batch_number) == expected


def test_numbers_in_texts_keep_their_size(spark):
    values = [12345678.5, 0.0005, 123456789012.25, -0.00025, 1e15, 4.5, 0.0, 99999999.75]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    texts = [r[0] for r in df.select(numbers.float_text(F.col("v"))).collect()]
    assert texts == [
        "12345678.5", "0.0005", "123456789012.25", "-0.00025", "1000000000000000.0", "4.5", "0.0",
        "99999999.75",
    ]
    quoted = df.select(text.quantities_text(F.col("v"), numbers.float_text(F.col("v"))).alias("d"))
    back = quoted.select(text.described_quantity(F.col("d"), "predicted")).collect()
    assert [float(r[0]) for r in back if r[0] != "N/A"] == [v for v in values if v >= 0]


def test_more_forms_of_times(spark):
    texts = ["2025-01-01T10:00:00+00:00", "2025-01-01T10:00:00.123456Z", "2025-01-01 10:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select(F.date_format(timestamps.parse_lenient(F.col("t")), "yyyy-MM-dd HH:mm")).collect()
    assert [r[0] for r in found] == ["2025-01-01 10:00"] * 3


def test_large_batch_numbers(spark):
    df = spark.createDataFrame([("P001-B3000000000",)], "product_id string")
    assert df.select(text.batch_number(F.col("product_id"))).first()[0] == 3_000_000_000
