from pyspark.sql import functions as F

from tallyspan.functions import columns as C
from tallyspan.operators import observatory as O


def one(spark, *cols, schema="x string", rows=((None,),)):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_mapping_keeps_unknown_and_null_apart(spark):
    got = one(spark, C.mapped(F.col("x"), {"a": "A"}, "unknown", on_null="waiting"), C.mapped(F.col("x"), {"a": "A"}, "unknown"), rows=[("a",), ("b",), (None,)])
    assert got == [("A", "A"), ("unknown", "unknown"), ("waiting", "unknown")]


def test_bands_are_half_open_and_null_is_last(spark):
    name, order = C.band(F.col("v"), O.BAND_EDGES, O.BAND_NAMES)
    got = one(spark, name, order, schema="v int", rows=[(1199,), (1200,), (2999,), (3000,), (-5,), (None,)])
    assert [o for _, o in got] == [1, 2, 9, 10, 1, 10]
    assert got[0][0] == "newbie" and got[5][0] == "legendary grandmaster"


def test_first_complete_key(spark):
    key = C.first_complete_key((F.col("a"), F.col("c")), (F.col("b"), F.col("c")))
    got = one(spark, key, schema="a int, b string, c string", rows=[(1, "s", "A"), (None, "s", "A"), (None, None, "A"), (1, "s", None)])
    assert [k for (k,) in got] == ["1A", "sA", None, None]


def test_corrupt_and_absent_differ(spark):
    v, bad = C.corrupt_below(F.col("v"), 0)
    assert one(spark, v, bad, schema="v int", rows=[(-1,), (0,), (None,)]) == [(None, True), (0, False), (None, False)]


def test_fraction_survives_odd_input(spark):
    assert one(spark, *C.fraction(F.col("x"), "/"), rows=[("3/4",), ("4",), ("a/b",), (None,), ("",)]) == [(3, 4), (4, None), (None, None), (None, None), (None, None)]


def test_text_and_keys(spark):
    got = one(spark, C.clean_text(F.col("x")), C.blank_to_null(F.col("x")), rows=[("  a \n b ",), ("   ",)])
    assert got == [("a b", "a \n b"), ("", None)]
    assert one(spark, C.surrogate_key(F.col("x"), C.OPENING), rows=[("abc",), (None,)])[1] == (None,)
    assert one(spark, C.full_match(F.col("x"), "p[0-9]{2}"), rows=[("p12",), ("xp12",), ("p123",)]) == [(True,), (False,), (False,)]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, C.percent(F.col("a"), F.col("b")), schema="a long, b long", rows=[(1, 3), (1, 0), (5, 4)]) == [(33.33,), (None,), (125.0,)]
