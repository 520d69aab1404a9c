import pytest

from reckoner.sinks.writers import delimited_lines
from reckoner.sources import bags

SCHEMA = "aspect string, word string, n int"


def parsed(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return {r.line: r for r in bags.parse_bags(df, "aspect", "words", SCHEMA).collect()}


def test_round_trip(spark):
    rows = [
        ("food", [("food", "good", 3), ("food", "(", 2), ("food", "a)", 1), ("food", "", 0)]),
        ("", []),
        ("a;b", [("a;b", "x{y}", -4), ("a;b", "two\nlines", 5)]),
    ]
    df = spark.createDataFrame(rows, f"aspect string, words array<struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>>")
    got = bags.parse_bags(delimited_lines(df, ";"), "aspect", "words", SCHEMA).collect()
    assert [r.reason for r in got] == [None] * 3
    assert [(r.aspect, [tuple(w) for w in r.words]) for r in got] == rows


@pytest.mark.parametrize(
    "line, reason",
    [
        ("food;{(food,3,5,2),(food,ok,1)}", bags.FIELDS),  # the word "3,5" holds the separator
        ("food;{(food,a),(b,2)}", bags.FIELDS),  # a word "a),(b" is not two tuples of three
        ("food;{(food,ok,many)}", bags.TYPES),
        ("food;{(food,;{,2)}", bags.START_UNSURE),
        ("food", bags.NO_BAG),
        ("food;{(food,ok,1)", bags.NO_BAG),
        ("food;{", bags.NO_BAG),
        ("", bags.NO_BAG),
        (None, bags.NO_BAG),
    ],
)
def test_refused_not_guessed(spark, line, reason):
    row = parsed(spark, [line, "x;{(x,y,1)}"])
    assert (row[line].aspect, row[line].words, row[line].reason) == (None, None, reason)
    assert row["x;{(x,y,1)}"].reason is None


def test_empty_fields(spark):
    row = parsed(spark, [";{(,,)}"])[";{(,,)}"]
    assert (row.aspect, [tuple(w) for w in row.words], row.reason) == ("", [("", "", None)], None)


def test_text_fields_only(spark):
    df = spark.createDataFrame([("k;{(a),(b)}",), ("k;{()}",)], "line string")
    got = bags.parse_bags(df, "k", "v", "x string").collect()
    assert [[w.x for w in r.v] for r in got] == [["a", "b"], [""]]
