import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyport.functions import copytext
from tallyport.functions.nulls import blank_to_null

DECODED = [
    ("plain", "plain"), ("", ""), (r"\N", None), (r"\\N", "\\N"), (r"a\tb", "a\tb"), (r"\b\f\n\r\v", "\b\f\n\r\v"), (r"\x41\x4", "A\x04"), (r"\101\7", "A\x07"),
    (r"\xc3\xa9", "é"), (r"\303\251", "é"), (r"\q", "q"), ("tail\\", "tail\\"), (r"\xzz", "xzz"), (r"\x00", "\x00"), (r"\501", "A"), (r"\xff", "\ufffd"),
]


def test_decode_table(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(DECODED)], "i int, raw string")
    got = {r.i: r.v for r in df.select("i", copytext.decode(F.col("raw")).alias("v")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(DECODED)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(blacklist_categories=("Cs",)), max_size=30)), min_size=1, max_size=20))
def test_encode_then_decode_is_identity(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    back = copytext.decoded(df.select("k", copytext.encode_line(F.col("k").cast("string"), F.col("v")).alias("line")), "line", ["i", "v"]).select(F.col("i").cast("int").alias("i"), "v", "good")
    assert back.where("NOT good").count() == 0
    assert {r.i: r.v for r in back.collect()} == dict(enumerate(values))


@pytest.mark.parametrize(("text", "kept"), [(None, None), ("", None), (" \t", None), ("\u00a0", None), (" x ", " x "), ("0", "0")])
def test_blank_rule(spark, text, kept):
    assert spark.createDataFrame([(text,)], "v string").select(blank_to_null(F.col("v")).alias("v")).first().v == kept


def test_fields_keep_trailing_empties_and_drop_carriage_return(spark):
    rows = spark.createDataFrame([("a\t\t",), ("a\tb\r",), ("",), ("\r",)], "raw string")
    assert [r.n for r in rows.select(F.size(copytext.fields(F.col("raw"))).alias("n")).collect()] == [3, 2, 0, 0]
