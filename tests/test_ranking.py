from homespan.operators import profile, ranking
from tests.frames import gold, labour, values

T = "All Residential"
HEADER = ["NAME", "B19013_001E", "B25077_001E", "B01003_001E", "B15003_022E", "B15003_001E", "B03002_001E",
          "B03002_003E", "state", "place"]


def census(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{h} string" for h in HEADER))


def place(name, income="50000", people="100", degrees="25", adults="80", majority="30"):
    return (name, income, "1", people, degrees, adults, people, majority, "48", "1")


def test_profile_types_names_and_percentages(spark):
    rows = census(spark, place("A city, Texas"), place("B town, Texas", income="x", degrees=None, adults="0"))
    got = {r[0]: tuple(r[1:]) for r in values(profile.place_profile(rows), "CITY", "MEDIAN_INCOME", "POPULATION",
                                             "DIVERSITY_PCT", "BACHELORS_PCT")}
    assert got == {"A": (50000.0, 100, 70.0, 31.2), "B": (None, 100, 70.0, None)}  # 31.25 rounds to the even 31.2


def test_match_keeps_each_place_once(spark):
    places = profile.place_profile(census(spark, place("A city, Texas"), place("B village, Texas"), place(None)))
    cities = spark.createDataFrame([("A",), ("A",), ("B",), (None,)], "CITY string")
    assert values(profile.match_cities(places, cities), "CITY") == [("A",)]


def test_largest_places_by_population(spark):
    rows = census(spark, place("A city, Texas", people="5"), place("B city, Texas", people="9"),
                  place("C city, Texas", people="9"), place("D city, Texas", people="?"))
    assert values(profile.largest_places(profile.place_profile(rows), 3), "CITY") == [("B",), ("C",), ("A",)]


def test_q6_combine_multiplies_duplicates_and_drops_null_keys(spark):
    places = profile.place_profile(
        census(spark, place("A city, Texas"), place("A town, Texas"), place("B city, Texas"), place(None))
    )
    market = gold(spark, ("A", 2024, T, 10.0, 1, 2.0), ("A", 2023, T, 99.0, 1, 2.0), ("A", 2024, "Condo", 98.0, 1, 2.0),
                  (None, 2024, T, 97.0, 1, 2.0))
    combined = ranking.combine(places, market, labour(spark, (2024, 4.0), (2024, 6.0)), 2024, T, 2024, metro="Metro")
    assert values(combined, "CITY", "AVG_SALE_PRICE", "UNEMPLOYMENT_RATE") == [("A", 10.0, 5.0)] * 2
    empty_year = ranking.combine(places, market, labour(spark, (2024, 4.0)), 2024, T, 2023, metro="Metro")
    assert values(empty_year, "UNEMPLOYMENT_RATE") == [(None,)] * 2


def ranked(spark, *rows):
    return spark.createDataFrame(list(rows), "CITY string, RANK int, OVERALL_SCORE double")


def test_head_and_tail_keep_rank_order(spark):
    df = ranked(spark, ("A", 1, 9.0), ("C", 3, 7.0), ("B", 2, 8.0), ("E", 4, 6.0), ("D", 4, 6.0), ("N", None, None))
    assert values(ranking.head(df, 2), "CITY") == [("A",), ("B",)]
    assert values(ranking.tail(df, 3), "CITY") == [("D",), ("E",), ("N",)]


def test_benchmark_overlap_in_benchmark_order(spark):
    df = ranked(spark, ("A", 1, 9.0), ("B", 2, 8.0), ("C", 3, 7.0))
    benchmark = ranking.benchmark_list(spark, ["C", "Q", "B", "A"])
    found = ranking.benchmark_matches(benchmark, df, depth=2).orderBy("POSITION")
    assert values(found) == [(3, "B"), (4, "A")]
    assert values(ranking.benchmark_agreement(benchmark, df, 2)) == [(2, 4, 0.5, "B, A")]
    assert values(ranking.benchmark_agreement(benchmark, df.limit(0), 2)) == [(0, 4, 0.0, "")]


def test_lookup_reports_misses(spark):
    df = ranked(spark, ("A", 1, 9.0), ("N", None, None))
    found = ranking.lookup(ranking.benchmark_list(spark, ["Z", "A", "N"]), df).orderBy("POSITION")
    assert values(found) == [(1, "Z", None, None, "not in dataset"), (2, "A", 1, 9.0, "ranked"), (3, "N", None, None, "ranked")]


def test_find_city_in_both_sources(spark):
    a = spark.createDataFrame([("Southlake",), ("North",)], "CITY string")
    b = spark.createDataFrame([("SOUTHLAKE",)], "CITY string")
    assert sorted(values(ranking.find_city({"census": a, "market": b}, "southlake"))) == [
        ("census", "Southlake"), ("market", "SOUTHLAKE"),
    ]
