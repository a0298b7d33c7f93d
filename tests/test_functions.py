"""Column functions on hand-written values in the source files' formats."""

import random

import pytest
from pyspark.sql import functions as F

from parcelle.functions import codes, numbers, text
from parcelle.functions.similarity import partial_ratio


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.v for r in df.select("i", function(F.col("c")).alias("v")).orderBy("i").collect()]


def test_commune_code(spark):
    rows = [("2A", "4"), ("1", "1"), ("75", "056"), ("974", "411"), (" 2B ", " 33 "), (None, "1")]
    df = spark.createDataFrame(rows, "dep string, com string")
    got = [r[0] for r in df.select(codes.commune_code(F.col("dep"), F.col("com"))).collect()]
    assert got == ["2A004", "01001", "75056", "974411", "2B033", None]


def test_codes(spark):
    assert apply(spark, lambda c: codes.zero_pad(c, 5), ["123", "12345", "123456", "", None]) == [
        "00123", "12345", "123456", "00000", None]
    assert apply(spark, codes.is_commune_code, ["75101", "2A004", "2C004", "1234", "123456"]) == [True, True, False, False, False]
    assert apply(spark, codes.merge_districts, ["75101", "69381", "69380", "69390", "13201", "13200", "13299", "7510", "2A004"]) == [
        "75056", "69123", "69123", "69390", "13055", "13200", "13055", "7510", "2A004"]
    assert apply(spark, codes.postal_code, ["75001.0", "1000", None, "nan", "x", "0"]) == ["75001", "01000", None, None, None, None]


def test_stable_id(spark):
    import hashlib

    names = ["Agglomération de Lyon", "Paris", "", "Saint-Étienne"] + [f"ville {i}" for i in range(200)]
    expected = [int(hashlib.md5(n.encode()).hexdigest(), 16) % 2_000_000_000 for n in names]
    assert apply(spark, codes.stable_id, names) == expected


def test_text(spark):
    assert apply(spark, text.clean_observatory_code, ["b1300.0", " b 13 00 ", "B６９00", None]) == ["B1300", "B1300", "B6900", None]
    assert apply(spark, text.clean_label, ["  Agglo  de \u0007 Lyon\t", "ﬁn", None]) == ["Agglo de Lyon", "fin", None]
    assert apply(spark, text.rooms_label, ["4P et plus", "4P  et plus ", "2P", None]) == ["4P+", "4P+", "2P", None]
    assert apply(spark, text.bare_name, [
        "Agglomération de Lyon (69)", "Communauté d'agglomération du Pays Basque", "EUROMÉTROPOLE de Strasbourg",
        "Agglomeration d'Annecy", "Unité urbaine de l'agglomération de Nice", "Paris",
    ]) == ["yon", "pays basque", "strasbourg", "d'annecy", "nice", "paris"]  # "de l" is an opening, "d'" is not
    assert apply(spark, text.city_of, ["Agglomération d'Annecy", "Agglomération Nice", "Arles"]) == ["Annecy", "Nice", "Arles"]
    assert apply(spark, text.zoning_code, ["x_L1300.zip", "x_l2a00.ZIP", "x_L13.zip"]) == ["B1300", "B2A00", None]
    assert apply(spark, text.null_token, ["nan", "a", None]) == [None, "a", None]
    assert apply(spark, lambda c: text.contains_ignore_case(c, F.lit("LYON")), ["Grand Lyon", "Paris", None]) == [True, False, False]


def test_folding_agrees_with_python(spark):
    words = ["Évreux", "ÎLE-de-Ré", "œuf", "Straße", "ŁÓDŹ", "Ǆ", "naïve", "été", "Ạ", "plain"]
    assert apply(spark, text.fold, words) == [text.fold_python(w) for w in words]
    assert apply(spark, lambda c: text.contains_folded(c, "évREUX"), ["Evreux", "Paris", None]) == [True, False, False]


def test_numbers(spark):
    assert apply(spark, numbers.to_number, ["12,5", " 7 ", "1.5", "12,5,1", "s", "nan", "12d", "3F", "1e3", "", None]) == [
        12.5, 7.0, 1.5, None, None, None, None, None, 1000.0, None, None]
    assert apply(spark, numbers.secret_to_null, ["s", "18250,5", None]) == [None, 18250.5, None]
    assert apply(spark, numbers.year_of, ["31/12/2021", "31/02/2021", "2021-01-01", None]) == [2021, None, None, None]
    assert apply(spark, lambda c: numbers.exact_round(c, 2), [1.005, 2.675, -1.005, None], "double") == [1.01, 2.68, -1.01, None]
    assert apply(spark, lambda c: numbers.exact_round(c, 2), [1.0049996, -1.0049996], "double") == [1.0, -1.0]
    assert apply(spark, numbers.rise_score, [None, -5.0, 10.0, 40.0], "double") == [0.0, 0.0, 50.0, 100.0]
    assert apply(spark, numbers.tension_band, [75.0, 74.9, 50.0, 25.0, 24.9, None], "double") == [
        "Très tendu", "Tendu", "Tendu", "Modéré", "Détendu", "Détendu"]
    assert apply(spark, numbers.access_band, [32.9, 33.0, 50.0], "double") == ["🟢 Accessible", "🟡 Tendu", "🔴 Difficile"]


def test_tension_score(spark):
    rows = [(None, None, None), (None, 10.0, 80.0), (120.0, 30.0, 40.0), (50.0, None, None)]
    df = spark.createDataFrame(rows, "ratio double, rise double, volume double")
    got = [r[0] for r in df.select(numbers.tension_score(F.col("ratio"), F.col("rise"), F.col("volume"))).collect()]
    assert got == pytest.approx([20.0, 62.0, 85.0, 32.5])


def slow_partial_ratio(a: str, b: str) -> float:
    """The definition, by dynamic programming over every window."""

    def common(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            last = 0
            for j, d in enumerate(y):
                last, row[j + 1] = row[j + 1], last + 1 if c == d else max(row[j], row[j + 1])
        return row[-1]

    def one_way(s, l):
        windows = [l[max(0, e - len(s)):e] for e in range(1, len(s) + len(l))]
        return max(200.0 * common(s, w) / (len(s) + len(w)) for w in windows)

    s, l = sorted((a, b), key=len)
    return max(one_way(s, l), one_way(l, s)) if len(s) == len(l) else one_way(s, l)


def test_partial_ratio():
    assert partial_ratio("", "") == 100.0 and partial_ratio("", "a") == 0.0
    assert partial_ratio("lyon", "grand lyon") == 100.0
    assert partial_ratio("abc", "xyz") == 0.0
    rng = random.Random(7)
    for _ in range(400):
        a, b = ("".join(rng.choice("abcd é") for _ in range(rng.randint(1, 12))) for _ in range(2))
        assert partial_ratio(a, b) == pytest.approx(slow_partial_ratio(a, b))
    long_name = "x" * 80 + "annecy"
    assert partial_ratio(long_name, "w" * 90) == 0.0
    assert partial_ratio("annecy" * 20, "z" + "annecy" * 20) == 100.0
