from datetime import datetime

import pytest
from helpers import rows

from reckoner.sources import datasets
from reckoner.sources.csv import read_declared, read_named, read_with_header
from reckoner.sources.memory import from_values
from reckoner.sources.staging import SETTING, clean, stage
from reckoner.sources.text import BOUNDED_STRICT, TRIMMED_LENIENT, TRIMMED_STRICT, Dialect, parse_lines, read_lines


def _file(folder, name, text):
    path = folder / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_trimmed_fields_and_last_line_without_newline(spark, tmp_path):
    path = _file(tmp_path, "movies", "1043, Paper Moons (1991), Animation|Comedy\n7, \tGale , Crime")
    movies = datasets.read_movies(spark, path, TRIMMED_STRICT)
    assert sorted(rows(movies)) == [("1043", "Paper Moons (1991)", "Animation|Comedy"), ("7", "Gale", "Crime")]


def test_comma_in_title_shifts_unbounded_but_genres_absorb_when_bounded(spark, tmp_path):
    path = _file(tmp_path, "movies", "1,Jaws,Thriller,Sea\n")
    assert rows(datasets.read_movies(spark, path, BOUNDED_STRICT)) == [(1, "Jaws", "Thriller,Sea")]
    assert rows(datasets.read_movies(spark, path, TRIMMED_STRICT)) == [("1", "Jaws", "Thriller")]


def test_blanks_are_kept_without_trim_but_numbers_parse(spark, tmp_path):
    path = _file(tmp_path, "movies", " 1 , Jaws ,Thriller\n")
    assert rows(datasets.read_movies(spark, path, BOUNDED_STRICT)) == [(1, " Jaws ", "Thriller")]


def test_user_with_empty_zip_is_short_only_where_trailing_empty_fields_vanish(spark, tmp_path):
    path = _file(tmp_path, "users", "1,F,25,10,\n2,M,30,11,70000\n")
    lenient = datasets.read_users(spark, path, TRIMMED_LENIENT)
    assert rows(lenient) == [("2", "M", 30, "11", "70000")]
    bounded = datasets.read_users(spark, path, BOUNDED_STRICT)
    assert sorted(rows(bounded)) == [(1, "F", 25, 10, ""), (2, "M", 30, 11, "70000")]


def test_comma_in_zip_stays_in_zip(spark, tmp_path):
    path = _file(tmp_path, "users", "1,F,25,10,700,00\n")
    assert rows(datasets.read_users(spark, path, BOUNDED_STRICT)) == [(1, "F", 25, 10, "700,00")]


def test_short_row_fails_drops_or_is_null(spark, tmp_path):
    lines = read_lines(spark, _file(tmp_path, "r", "1,2,4.5,9\n1,2\n"))
    schema = datasets.RATINGS.format(id="bigint")
    with pytest.raises(Exception, match="fewer than 4 fields: 1,2"):
        parse_lines(lines, schema, Dialect()).collect()
    assert rows(parse_lines(lines, schema, Dialect(on_short_row="drop"))) == [(1, 2, 4.5, 9)]
    assert rows(parse_lines(lines, schema, Dialect(on_short_row="null"))) == [(1, 2, 4.5, 9), (1, 2, None, None)]
    assert rows(parse_lines(lines, schema, Dialect(), columns=["movie_id"])) == [(2,), (2,)]
    with pytest.raises(ValueError):
        parse_lines(lines, schema, Dialect(on_short_row="skip"))


def test_a_run_of_separators_inside_a_line_is_quick(spark, tmp_path):
    path = _file(tmp_path, "r", "1,2,4.5" + "," * 200_000 + "x\n3,4,5.0,,,,\n")
    got = datasets.read_ratings(spark, path, TRIMMED_STRICT, ["user_id", "rating"])
    assert sorted(rows(got)) == [("1", 4.5), ("3", 5.0)]


def test_large_and_text_ids(spark, tmp_path):
    path = _file(tmp_path, "r", "3000000000,2,4.5,9\n")
    assert rows(datasets.read_ratings(spark, path, BOUNDED_STRICT)) == [(3000000000, 2, 4.5, 9)]
    path = _file(tmp_path, "m", "M10, Ten\n")
    assert rows(datasets.read_movies(spark, path, TRIMMED_STRICT, ["movie_id", "title"])) == [("M10", "Ten")]


def test_rows_with_a_bad_age_go_before_one_row_per_user_is_chosen(spark, tmp_path):
    path = _file(tmp_path, "u", "1,M,25,3,7\n1,M,n/a,3,7\n2,F,x,3,7\n")
    users = datasets.read_users(spark, path, TRIMMED_LENIENT, ["user_id", "age"], skip_bad_age=True)
    assert rows(users) == [("1", 25)]


def test_ratings_may_lack_fields_nobody_reads(spark, tmp_path):
    path = _file(tmp_path, "r", "1,2,4.5\n")
    ratings = datasets.read_ratings(spark, path, TRIMMED_STRICT, ["movie_id", "rating"])
    assert rows(ratings) == [("2", 4.5)]


def test_bad_number_fails_or_is_null(spark, tmp_path):
    path = _file(tmp_path, "r", "1,2,good,9\n")
    with pytest.raises(Exception, match="not a valid double: good"):
        datasets.read_ratings(spark, path, TRIMMED_STRICT).collect()
    lenient = Dialect(on_bad_number="null")
    assert rows(datasets.read_ratings(spark, path, lenient)) == [(1, 2, None, 9)]


def test_bad_number_in_a_column_not_asked_for_is_no_failure(spark, tmp_path):
    path = _file(tmp_path, "users", "1,F,25,none,70000\n")
    users = datasets.read_users(spark, path, TRIMMED_LENIENT, columns=["user_id", "gender"])
    assert rows(users) == [("1", "F")]


def test_folder_and_list_of_files(spark, tmp_path):
    a = _file(tmp_path, "ratings_1", "1,1,4.0,9\n")
    b = _file(tmp_path, "ratings_2", "1,1,4.0,9\n2,1,3.0,9\n")
    for path in (str(tmp_path), [a, b]):
        assert datasets.read_ratings(spark, path, TRIMMED_STRICT).count() == 3


def test_repeated_dimension_key_keeps_one_row(spark, tmp_path):
    path = _file(tmp_path, "movies", "1,Jaws,A\n1,Jaws II,B\n2,Heat,C\n")
    movies = datasets.read_movies(spark, path, BOUNDED_STRICT)
    assert sorted(rows(movies)) == [(1, "Jaws II", "B"), (2, "Heat", "C")]


def test_occupation_name_may_hold_commas(spark, tmp_path):
    path = _file(tmp_path, "o", "1,Clerk, senior\n")
    assert rows(datasets.read_occupations(spark, path, BOUNDED_STRICT)) == [(1, "Clerk, senior")]


def test_reviews_are_lenient_and_unquoted(spark, tmp_path):
    text = '1;"phòng sạch;ROOMS;CLEAN;positive\nx;tốt "lắm";HOTEL;GENERAL;negative\n3;ngắn\n4;;HOTEL;GENERAL;positive\n'
    reviews = datasets.read_reviews(spark, _file(tmp_path, "reviews", text))
    assert rows(reviews) == [
        (1, '"phòng sạch', "ROOMS", "CLEAN", "positive"),
        (None, 'tốt "lắm"', "HOTEL", "GENERAL", "negative"),
        (3, "ngắn", None, None, None),
        (4, None, "HOTEL", "GENERAL", "positive"),
    ]


def test_separator_in_review_shifts_columns(spark, tmp_path):
    path = _file(tmp_path, "reviews", "1;sạch; đẹp;HOTEL;GENERAL;positive\n")
    assert rows(read_declared(spark, path, datasets.REVIEWS)) == [(1, "sạch", " đẹp", "HOTEL", "GENERAL")]


def test_stop_words_are_first_tab_field(spark, tmp_path):
    path = _file(tmp_path, "stop", "là\ncủa\tx\nchúng tôi\nlà\n")
    assert [r[0] for r in rows(datasets.read_stop_words(spark, path))] == ["là", "của", "chúng tôi", "là"]


def test_header_inferred_and_declared(spark, tmp_path):
    head = "Order_ID;Customer_Trx_ID;Order_Status;Order_Purchase_Timestamp;Order_Approved_At;"
    head += "Order_Delivered_Carrier_Date;Order_Delivered_Customer_Date;Order_Estimated_Delivery_Date\n"
    line = "a1;c1;delivered;2023-10-02 10:56;2023-10-02 11:07:00;;2023-10-10 21:25:00;2023-10-18 00:00:00\n"
    path = _file(tmp_path, "orders.csv", head + line)
    declared, inferred = datasets.read_table(spark, path, datasets.ORDERS), datasets.read_inferred(spark, path)
    assert declared.dtypes == [("order_id", "string"), ("customer_id", "string"), ("purchased_at", "timestamp"), ("delivered_at", "timestamp")]
    assert dict(inferred.dtypes)["Order_Purchase_Timestamp"] == "timestamp"
    assert declared.first().purchased_at == inferred.first().Order_Purchase_Timestamp == datetime(2023, 10, 2, 10, 56)
    assert declared.first().delivered_at is None
    number = _file(tmp_path, "n.csv", "a;b\n1;2.5\n")
    assert read_with_header(spark, number).dtypes == [("a", "int"), ("b", "double")]
    assert read_with_header(spark, number, infer=False).dtypes == [("a", "string"), ("b", "string")]


def test_columns_are_found_by_the_header(spark, tmp_path):
    path = _file(tmp_path, "o.csv", "Customer_Trx_ID;x;Order_Purchase_Timestamp;Order_ID\nc1;1;2023-10-02 10:56:00;a1\nc2;1;soon;a2\n")
    names = ("order_id", "customer_id")
    assert rows(datasets.read_table(spark, path, datasets.ORDERS, names)) == [("a1", "c1"), ("a2", "c2")]
    wanted = {"Order_Purchase_Timestamp": ("at", "timestamp")}
    with pytest.raises(Exception, match="not a valid timestamp: soon"):
        read_named(spark, path, wanted).collect()
    assert rows(read_named(spark, path, wanted, on_bad="null")) == [(datetime(2023, 10, 2, 10, 56),), (None,)]


def test_values_are_a_relation_of_known_size(spark):
    df = from_values(spark, [1, 2, 3], "x", "int")
    assert [r[0] for r in rows(df)] == [1, 2, 3]


def test_stage_reads_the_folder_of_the_session(spark):
    staged = stage(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    assert all(spark.conf.get(SETTING) in f for f in staged.inputFiles())
    assert sorted(rows(staged))[-1] == (9, 18)


def test_stages_are_removed_and_need_a_folder(spark, monkeypatch, tmp_path):
    staged = stage(spark.range(3).toDF("id"), str(tmp_path))
    assert list(tmp_path.iterdir()) and staged.count() == 3
    clean(spark)
    assert not list(tmp_path.iterdir())
    monkeypatch.setattr("reckoner.sources.staging.SETTING", "spark.reckoner.no.such.setting")
    df = spark.range(3)
    assert stage(df) is df
