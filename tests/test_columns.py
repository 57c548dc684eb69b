"""Column functions on the edge cases the models meet."""

from __future__ import annotations

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from caseloom.functions import codes, dates, documents, keys, text


def values(spark, rows, fn, schema="v string"):
    df = spark.createDataFrame([(r,) for r in rows], schema)
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_strip_accents_equals_decomposition(spark):
    words = ["João", "ÀÉÎÕÜ çñ", "Ångström", "straße", "Việt Nam", "é"]
    plain = ["".join(c for c in unicodedata.normalize("NFD", w) if not unicodedata.combining(c)) for w in words]
    assert values(spark, words, text.strip_accents) == plain


def test_clean_and_standard_name(spark):
    names = ["  José  da SILVA-e Souza 3º ", "", None, "DOS", "Ana\tdas  Dores"]
    assert values(spark, names, text.clean_name) == ["jose da silva e souza", "", None, "dos", "ana das dores"]
    assert values(spark, names, text.standard_name) == ["jose silva souza", "", None, "", "ana dores"]


def test_match_and_digit_keys(spark):
    assert values(spark, ["João d'Ávila 2", None, "DA"], text.match_key) == ["JOAODAVILA2", "", ""]
    assert values(spark, ["123.456-7", None], text.digits_key) == ["1234567", ""]


def test_extract_is_null_without_match(spark):
    assert values(spark, ["a=1", "b"], lambda c: text.extract_or_null(c, "a=(.)")) == ["1", None]


def test_null_words(spark):
    assert values(spark, ["None", " nan", "NaT", "<NA>", "", "x", None], text.null_words) == [None] * 5 + ["x", None]


def test_test_names_and_accounts(spark):
    assert values(spark, ["Victor", "Teste Victor", "TesteVictor", None], text.is_test_name) == [False, True, True, False]
    accounts = ["victor", "teste_victor", "admin_victor", "suporte_victor"]
    assert values(spark, accounts, lambda c: text.is_admin_account(c, c)) == [False, True, True, True]


def test_clock(spark):
    assert values(spark, ["7", "930", "1415", "09:30", "", None], text.hhmm) == ["00:07", "09:30", "14:15", "09:30", "", None]
    assert values(spark, [930, 5], text.hhmm_from_number, "v int") == ["09:30", "00:05"]


def test_trim_space_takes_tabs_and_hard_blanks(spark):
    assert values(spark, ["\t a b \n"], text.trim_space) == ["a b"]


@pytest.mark.parametrize(
    ("domain", "expected"),
    [
        (codes.Domain({"1": "one"}), ["one", None, None]),
        (codes.Domain({"1": "one"}, default="other", null_label="none"), ["one", "other", "none"]),
        (codes.Domain({"1": "one"}, default=codes.KEEP), ["one", "25", None]),
        (codes.Domain({"2": "two.."}, match="prefix"), [None, "two..", None]),
        (codes.Domain({"5": "five"}, match="contains"), [None, "five", None]),
    ],
)
def test_domain_variants(spark, domain, expected):
    assert values(spark, ["1", "25", None], lambda c: codes.map_domain(c, domain)) == expected


def test_map_list_keeps_unknown_token_only(spark):
    domain = codes.Domain({"1": "one"}, default=codes.KEEP)
    assert values(spark, ["1, 9,1"], lambda c: codes.map_list(c, domain)) == ["one,9,one"]


def test_bands_and_flags(spark):
    limits = [(7, "week"), (28, "month")]
    assert values(spark, [7, 8, 29, None], lambda c: codes.bands(c, limits, "long", "?"), "v int") == ["week", "month", "long", "?"]


def test_parse_date_takes_first_fit(spark):
    rows = ["2024-02-29", "1/3/2024", "31/02/2024", "x", None]
    day = dt.date
    assert values(spark, rows, lambda c: dates.parse_date(c, "yyyy-MM-dd", "d/M/yyyy")) == [day(2024, 2, 29), day(2024, 3, 1), None, None, None]


def test_ages_differ_by_definition(spark):
    births = [dt.date(2000, 8, 1), dt.date(2000, 8, 2), dt.date(2000, 12, 31), None]
    run = lambda mode: values(spark, births, lambda c: dates.age(c, "2023-08-01", mode), "v date")
    assert run("exact") == [23, 22, 22, None]
    assert run("boundary") == [23, 23, 23, None]
    # 1 August is day 214 of the leap year 2000 but day 213 of 2023
    assert run("dayofyear") == [22, 22, 22, None]


def test_epoch_millis_round_trip(spark):
    days = [dt.date(1969, 12, 31), dt.date(2024, 2, 29)]
    assert values(spark, days, lambda c: dates.epoch_millis_to_date(dates.date_to_epoch_millis(c) + 5), "v date") == days


def test_day_range_is_empty_when_reversed(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), dt.date(2024, 1, 1))], "a date, b date")
    assert df.select(dates.day_range(F.col("a"), F.col("b"))).first()[0] == []


def test_document_numbers(spark):
    rows = [None, "..", "1", "529.982.247-25", "123456789012"]
    assert values(spark, rows, documents.doc_status) == ["empty", "empty", "ok", "ok", "invalid"]
    assert values(spark, rows, documents.doc_digits) == ["", "", "00000000001", "52998224725", "123456789012"]
    assert values(spark, rows, documents.doc_format) == [None, None, "000.000.000-01", "529.982.247-25", None]


def test_surrogate_key_marks_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    rows = [r[0] for r in df.select(keys.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(rows)) == 2


def test_row_hash_sees_null_fields(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    assert df.select(keys.row_hash(F.col("x"), F.col("y")).alias("h")).distinct().count() == 2


def test_accents_beyond_latin_blocks(spark):
    df = spark.createDataFrame([("\u212b\u212a \u1ebe",)], "s string")
    assert df.select(text.strip_accents(F.col("s"))).first()[0] == "AK E"
