"""Fields of text that their types can't hold."""

from tallyframe.sources import readers as R


def test_numbers_of_too_many_digits_are_no_error(spark):
    lines = spark.createDataFrame([(1, "n 123456789012345678901"), (1, "n 7"), (2, "n 999999999999999999999"), (3, "n 2"), (3, "n 3"), (4, "none")], "file int, text string")
    found = R.extract_fields(lines, [("low", r"n (\d+)", "bigint", "min", False), ("all", r"n (\d+)", "bigint", "sum", False)])[0]
    assert sorted(map(tuple, found.collect())) == [(1, 7, None), (2, None, None), (3, 2, 5), (4, None, None)]
