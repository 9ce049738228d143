"""Documents with everything that may go wrong in them."""

import pytest

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew potent ale near old stone bridges"
LONG = " ".join(f"word{i % 997} and{i}" for i in range(40_000))

# doc_id, text, source and a column whose name the operators use themselves.
ROWS = [
    (1, PROSE, "a", "x"),
    (2, PROSE, "b", "x"),
    (2, PROSE, "b", "x"),
    (3, PROSE.upper() + " indeed", "c", None),
    (4, None, "d", "x"),
    (5, "", None, "x"),
    (6, " \n\t ", "a", "x"),
    (None, PROSE, "a", "x"),
    (None, None, None, None),
    (7, LONG, "a", "x"),
    (8, LONG + " end", "b", "x"),
    (9, "short text", "c", "x"),
    (10, "short  text", "c", "x"),
]
SCHEMA = "doc_id long, text string, source string, {} string"


@pytest.fixture(scope="session")
def odd(spark):
    """A frame of the odd rows; the last column gets the name asked for."""
    return lambda name="kept": spark.createDataFrame(ROWS, SCHEMA.format(name))
