from collections import Counter

import pytest
from helpers import rows

from reckoner.plans import reviews as plans
from reckoner.sinks.writers import delimited_lines

REVIEWS = [
    (1, "Phòng SẠCH, phòng  đẹp", "ROOMS", "CLEAN", "positive"),
    (2, "phòng là của tôi", "ROOMS", "CLEAN", "negative"),
    (3, "phòng tệ tệ", "ROOMS", "PRICE", "negative"),
    (4, None, "ROOMS", "PRICE", "positive"),
    (5, "khách sạn tốt", "HOTEL", "CLEAN", "neutral"),
    (6, '"tốt" lắm', "HOTEL", "PRICE", "Positive"),
    (None, "phòng tốt", "HOTEL", "CLEAN", "positive"),
    (8, "phòng\tđẹp chúng tôi", None, None, None),
]
STOP = ["là", "của", "là", "chúng tôi", "tôi"]


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(REVIEWS, "id int, review string, category string, aspect string, sentiment string")


@pytest.fixture
def stop(spark):
    return spark.createDataFrame([(w,) for w in STOP], "word string")


def test_clean_words(reviews, stop):
    got = Counter(rows(plans.clean_words(reviews, stop)))
    want = Counter(
        (r[0], w)
        for r in REVIEWS
        if r[1] is not None
        for w in r[1].lower().split(" ")
        if w and w not in STOP
    )
    assert got == want
    assert (8, "phòng\tđẹp") in got and (8, "chúng") in got and (1, "sạch,") in got
    assert not {w for _, w in got} & set(STOP)


def test_word_frequency_keeps_stop_words_and_skips_missing_ids(reviews):
    got = dict(rows(plans.word_frequency(reviews)))
    assert got["phòng"] == 4 and got["là"] == 1 and got["tệ"] == 2 and got["tốt"] == 1 and got['"tốt"'] == 1
    over = dict(rows(plans.frequent_words(reviews, 2)))
    assert over == {"phòng": 4} and over.items() <= got.items()


def test_reviews_by_group_count_ids(reviews):
    assert dict(rows(plans.reviews_by(reviews, "category"))) == {"ROOMS": 4, "HOTEL": 2, None: 1}
    assert dict(rows(plans.reviews_by(reviews, "aspect"))) == {"CLEAN": 3, "PRICE": 3, None: 1}


def test_top_aspects_keep_ties_and_top_aspect_does_not(reviews):
    assert sorted(rows(plans.top_aspects(reviews, "negative"))) == [("CLEAN", 1), ("PRICE", 1)]
    assert rows(plans.top_aspect(reviews, "negative")) == [("CLEAN", 1)]
    # A review without id does not count for CLEAN, and the label is case-sensitive.
    assert sorted(rows(plans.top_aspects(reviews, "positive"))) == [("CLEAN", 1), ("PRICE", 1)]
    assert rows(plans.top_aspects(reviews, "mixed")) == []


def test_top_words(reviews, stop):
    rooms = [r[1:] for r in rows(plans.top_words(reviews, stop, 3).filter("category = 'ROOMS'"))]
    assert sorted(rooms) == [(1, "phòng", 4), (2, "tệ", 2), (3, "sạch,", 1)] or sorted(rooms) == [
        (1, "phòng", 4),
        (2, "tệ", 2),
        (3, "đẹp", 1),
    ]
    assert min("sạch,".encode(), "đẹp".encode()) == "sạch,".encode()
    positive = rows(plans.top_words(reviews, stop, 1, "positive"))
    assert sorted(positive) == [("HOTEL", 1, "phòng", 1), ("ROOMS", 1, "phòng", 2)]
    # Words of a missing category count zero, as its first field is missing.
    missing = rows(plans.top_words(reviews, stop, 5).filter("category IS NULL"))
    assert {r[3] for r in missing} == {0}


def test_short_and_long_stop_lists_agree(reviews, stop, conf):
    short = sorted(rows(plans.top_words(reviews, stop).dropna()))
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    assert sorted(rows(plans.top_words(reviews, stop).dropna())) == short


def test_nested_bags_as_text(reviews, stop):
    top = plans.top_words(reviews, stop, 2).filter("category = 'ROOMS'")
    nested = plans.nested_top_words(top)
    assert nested.dtypes[1][1] == "array<struct<category:string,word:string,cnt:bigint>>"
    assert [r.line for r in delimited_lines(nested, ";").collect()] == ["ROOMS;{(ROOMS,phòng,4),(ROOMS,tệ,2)}"]
