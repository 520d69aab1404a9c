"""Every program from files to files."""

import glob

import pytest

from reckoner.jobs import JOBS, main, run

FILES = {
    "ratings": "1, 10, 4.0, 1577836800\n2, 10, 5.0, 1577836800\n1, 9, 3.0, 1577836800\n",
    "ratings_1": "1,10,4.0,1577836800\n",
    "ratings_2": "2,10,5.0,1577836800\n1,9,3.0,1577836799\n",
    "movies": "10,Ten,Drama|Crime\n9,Nine,Drama\n",
    "users": "1,M,17,3,70000\n2,F,40,4,70000\n",
    "occupations": "3,Clerk\n",
    "reviews": "1;Phòng sạch phòng;ROOMS;CLEAN;positive\n2;phòng là tệ;ROOMS;PRICE;negative\n3;là;HOTEL;CLEAN;negative\n",
    "stop_words": "là\nlà\nchúng tôi\n",
    "orders": "Order_ID;Customer_Trx_ID;Order_Status;Order_Purchase_Timestamp;Order_Approved_At;"
    "Order_Delivered_Carrier_Date;Order_Delivered_Customer_Date;Order_Estimated_Delivery_Date\n"
    "a;c1;delivered;2023-10-02 10:56:00;;2023-10-07 08:00:00;;\nb;c2;delivered;2023-11-02 10:56:00;;;;\nc;c1;sent;;;;;\n",
    "items": "Seller_ID;Order_ID;Product_ID;Shipping_Limit_Date;Price;Freight_Value\n"
    "s1;a;p1;2023-10-05 00:00:00;10.00;1.50\ns1;b;p1;2023-11-01 00:00:00;20.00;2.00\ns2;b;p2;;5.25;0.00\n",
    "products": "Product_ID;Product_Category_Name\np1;toys\np2;books\n",
    "order_reviews": "Review_ID;Order_ID;Review_Score\nr1;a;5\nr2;a;4\nr3;b;1\nr4;b;6\nr5;c;abc\nr6;b;\n",
    "customers": "Customer_Trx_ID;Customer_Country;Customer_Country_Code\nc1;Germany;DE\nc2;France;FR\n",
}
NA = "N/A            "
# Lines of each output; a set or tuple where the program leaves the order open.
EXPECTED = {
    "movie_pairs": {
        "means": ["Ten\tDiem Trung Binh: 4.5 (Tong so luot: 2)", "Nine\tDiem Trung Binh: 3.0 (Tong so luot: 1)"],
        "champion": [
            "=> QUAN QUAN: \t is the highest rated movie with an average rating of 0.0"
            " among movies with at least 5 ratings."
        ],
    },
    "genre_pairs": {"means": ["Crime\tAvg: 4.50, Count: 2", "Drama\tAvg: 4.00, Count: 3"]},
    "gender_pairs": {"means": ["Ten\tMale: 4.00, Female: 5.00", "Nine\tMale: 3.00, Female: 0.00"]},
    "age4_pairs": {
        "means": [
            "Ten\t0-18: 4.00   18-35: NA   35-50: 5.00   50+: NA",
            "Nine\t0-18: 3.00   18-35: NA   35-50: NA   50+: NA",
        ]
    },
    "movie_lines": {
        "means": {
            "--- DANH SÁCH TỔNG HỢP PHIM ---",
            "MovieID: 10 | Title: Ten | AvgRating: 4.50 | Count: 2",
            "MovieID: 9 | Title: Nine | AvgRating: 3.00 | Count: 1",
        },
        "winner": [
            "--- PHIM CÓ ĐIỂM TRUNG BÌNH CAO NHẤT (>= 5 LƯỢT ĐÁNH GIÁ) ---",
            "Không có phim nào đạt điều kiện >= 5 lượt đánh giá.",
        ],
    },
    "genre_lines": {
        "means": {
            "--- ĐIỂM TRUNG BÌNH THEO THỂ LOẠI PHIM ---",
            "Genre: Crime           | AvgRating: 4.50 | Total Ratings: 2",
            "Genre: Drama           | AvgRating: 4.00 | Total Ratings: 3",
        }
    },
    "gender_lines": {
        "means": [
            "--- DIEM TRUNG BINH THEO PHIM VA GIOI TINH ---",
            f"MovieID: 9     | {'Nine':40} | Male Avg: 3.00  | Female Avg: N/A  ",
            f"MovieID: 10    | {'Ten':40} | Male Avg: 4.00  | Female Avg: 5.00 ",
        ]
    },
    "age7_lines": {
        "means": [
            "--- ĐIỂM TRUNG BÌNH PHIM THEO NHÓM TUỔI ---",
            f"ID: 9    | {'Nine':35} | <18: 3.00 (1 votes)  | 18-24: {NA} | 25-34: {NA} | 35-44: {NA}"
            f" | 45-49: {NA} | 50-55: {NA} | 56+: {NA}",
            f"ID: 10   | {'Ten':35} | <18: 4.00 (1 votes)  | 18-24: {NA} | 25-34: {NA} | 35-44: 5.00 (1 votes) "
            f" | 45-49: {NA} | 50-55: {NA} | 56+: {NA}",
        ]
    },
    "occupation_lines": {
        "means": [
            "--- ĐIỂM TRUNG BÌNH THEO NGHỀ NGHIỆP ---",
            "Occupation: Unknown              | AvgRating: 5.00 | Total Ratings: 1",
            "Occupation: Clerk                | AvgRating: 3.50 | Total Ratings: 2",
        ]
    },
    "year_lines": {
        "means": [
            "--- ĐIỂM TRUNG BÌNH VÀ TỔNG LƯỢT ĐÁNH GIÁ THEO NĂM ---",
            "Year: 2019 | AvgRating: 3.00 | Total Ratings: 1",
            "Year: 2020 | AvgRating: 4.50 | Total Ratings: 2",
        ]
    },
    "clean_words": {"words": ("1;phòng", "1;phòng", "1;sạch", "2;phòng", "2;tệ")},
    "word_counts": {
        "all_words": {"phòng;3", "sạch;1", "là;2", "tệ;1"},
        "frequent_words": [],
        "categories": {"ROOMS;2", "HOTEL;1"},
        "aspects": {"CLEAN;2", "PRICE;1"},
    },
    "top_aspects": {"negative": {"CLEAN;1", "PRICE;1"}, "positive": ["CLEAN;1"]},
    "top_aspect": {"negative": ["CLEAN;1"], "positive": ["CLEAN;1"]},
    "top_words_by_sentiment": {
        "positive": ["ROOMS;{(ROOMS,phòng,2),(ROOMS,sạch,1)}"],
        "negative": ["ROOMS;{(ROOMS,phòng,1),(ROOMS,tệ,1)}"],
    },
    "top_words": {"top_words": ["ROOMS;{(ROOMS,phòng,3),(ROOMS,sạch,1),(ROOMS,tệ,1)}"]},
    "order_schema": {
        "schema": [
            "Cấu trúc Schema:",
            "root",
            " |-- Order_ID: string (nullable = true)",
            " |-- Customer_Trx_ID: string (nullable = true)",
            " |-- Order_Status: string (nullable = true)",
            " |-- Order_Purchase_Timestamp: timestamp (nullable = true)",
            " |-- Order_Approved_At: string (nullable = true)",
            " |-- Order_Delivered_Carrier_Date: timestamp (nullable = true)",
            " |-- Order_Delivered_Customer_Date: string (nullable = true)",
            " |-- Order_Estimated_Delivery_Date: string (nullable = true)",
        ]
    },
    "order_totals": {"totals": {"Tổng số đơn hàng: 3", "Tổng số khách hàng: 2", "Tổng số người bán: 2"}},
    "orders_by_country": {
        "countries": [
            "Số lượng đơn hàng theo quốc gia:",
            "+----------------+-----+",
            "|Customer_Country|count|",
            "+----------------+-----+",
            "|Germany         |2    |",
            "|France          |1    |",
            "+----------------+-----+",
        ]
    },
    "orders_by_month": {
        "months": [
            "Số lượng đơn hàng nhóm theo năm, tháng đặt hàng (Năm tăng dần, Tháng giảm dần):",
            "+----+-----+-----+",
            "|Year|Month|count|",
            "+----+-----+-----+",
            "|NULL|NULL |1    |",
            "|2023|11   |1    |",
            "|2023|10   |1    |",
            "+----+-----+-----+",
        ]
    },
    "review_scores": {"scores": ["1;1;3.3333333333333335", "4;1;3.3333333333333335", "5;1;3.3333333333333335"]},
    "revenue_by_category": {"revenue": {"toys;33.50", "books;5.25"}},
    "best_selling_product": {"product": ["p1;2"]},
    "product_scores": {"scores": {"p1;3.3333333333333335;3", "p2;1.0;1"}},
    "delivery_delay": {"delay": ["1;2.0;1.0"]},
    "customer_segments": {
        "customers": {"c1;2;5.75;60.0;loyal", "c2;1;27.25;30.0;one-time"},
        "segments": {"loyal;1", "one-time;1"},
    },
    "seller_ranking": {"sellers": ["s1;33.50;2;1", "s2;5.25;1;2"]},
}
OPTIONS = {"revenue_by_category": {"year": "2023"}}


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    for name, text in FILES.items():
        (folder / name).write_text(text, encoding="utf-8")
    return {name: str(folder / name) for name in FILES}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job(spark, paths, tmp_path, name):
    inputs = {i: paths[i] for i in JOBS[name].inputs} | OPTIONS.get(name, {})
    run(spark, name, inputs, str(tmp_path))
    for output, lines in EXPECTED[name].items():
        text = "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{tmp_path}/{output}/part-*")))
        got = text.split("\n")[:-1]
        assert got == lines if isinstance(lines, list) else sorted(got) == sorted(lines)
    assert set(EXPECTED[name]) == {p.rstrip("/").rsplit("/", 1)[1] for p in glob.glob(f"{tmp_path}/*/")}


def lines_of(spark, name, tmp_path, files, output, **options):
    for key, text in files.items():
        (tmp_path / key).write_text(text, encoding="utf-8")
    out = tmp_path / "out"
    run(spark, name, {key: str(tmp_path / key) for key in files} | options, str(out))
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(f"{out}/{output}/part-*"))).split("\n")[:-1]


def test_rows_are_as_long_as_the_program_reads(spark, tmp_path):
    """No genres, no time, only id and gender; text ids where they are compared, large ones where they are numbers."""
    files = {"ratings": "1, M10, 4.0\n", "movies": "M10, Ten, \n"}
    assert lines_of(spark, "movie_pairs", tmp_path, files, "means") == ["Ten\tDiem Trung Binh: 4.0 (Tong so luot: 1)"]


def test_short_users_and_large_ids(spark, tmp_path):
    files = {"ratings_1": "3000000000,10,4.0\n", "ratings_2": "2,10,5.0\n", "users": "3000000000,M\n2,F\n", "movies": "10,Ten,\n"}
    got = lines_of(spark, "gender_lines", tmp_path, files, "means")
    assert got[1:] == [f"MovieID: 10    | {'Ten':40} | Male Avg: 4.00  | Female Avg: 5.00 "]


def test_a_repeated_user_with_a_bad_age_keeps_the_good_one(spark, tmp_path):
    files = {"ratings": "1,10,4.0,9\n", "movies": "10,Ten,A\n", "users": "1,M,25,3,7\n1,M,n/a,3,7\n"}
    assert lines_of(spark, "age4_pairs", tmp_path, files, "means") == ["Ten\t0-18: NA   18-35: 4.00   35-50: NA   50+: NA"]


def _many(value, n):
    return "".join(f"{i},10,{value},9\n" for i in range(n))


def test_champion_and_winner(spark, tmp_path):
    files = {"ratings": _many(4.5, 6) + "1,9,5.0,9\n", "movies": "10,Ten,A\n9,Nine,B\n"}
    got = lines_of(spark, "movie_pairs", tmp_path, files, "champion")
    want = "Ten is the highest rated movie with an average rating of 4.5 among movies with at least 5 ratings."
    assert got == [f"=> QUAN QUAN: \t{want}"]


def test_a_mean_of_zero_wins_only_where_the_program_lets_it(spark, tmp_path):
    files = {"ratings_1": _many(0.0, 3), "ratings_2": _many(0.0, 3), "movies": "10,Ten,A\n"}
    got = lines_of(spark, "movie_lines", tmp_path, files, "winner")
    assert got[1] == "WINNER -> Title: 'Ten' | Điểm: 0.00 | Lượt đánh giá: 6"


def test_support_and_threshold_are_options(spark, tmp_path):
    files = {"reviews": "1;" + "hot " * 501 + "cold;A;B;positive\n"}
    assert lines_of(spark, "word_counts", tmp_path, files, "frequent_words") == ["hot;501"]
    again = tmp_path / "again"
    again.mkdir()
    assert lines_of(spark, "word_counts", again, files, "frequent_words", more_than="501") == []


def test_usage_and_missing_input(spark, tmp_path, capsys):
    assert main([]) == 2
    assert "year_lines: ratings_1=PATH ratings_2=PATH out=FOLDER" in capsys.readouterr().out
    with pytest.raises(ValueError, match="year_lines needs ratings_2"):
        run(spark, "year_lines", {"ratings_1": "x"}, str(tmp_path))
