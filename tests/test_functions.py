"""Column functions on hand-made values."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from stallmetrics.functions import clock, filters, keys, markup, money, text, web
from tests.conftest import one


def value(spark, data, fn, kind="string"):
    """fn over a one-column frame, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_turkish_order_of_repairs(spark):
    given = ["  Güneş  Çiçek ", None, "Ä°zmir", "Ã¼", "Å\x9f", "ÄŸ", "0STANBUL avrupa", "Istanbul (Anadolu)", "a   b"]
    assert value(spark, given, text.normalize_turkish) == [
        "Gunes Cicek", None, "Izmir", "A¼", "S\x9f", "g", "ISTANBUL-AVRUPA", "ISTANBUL-ANADOLU", "a  b"]


def test_normalize_turkish_trims_any_white_space(spark):
    assert value(spark, ["\t x y\n"], text.normalize_turkish) == ["x y"]


def test_first_category_rule_wins(spark):
    given = ["Kırmızı GÜL ve Orkide", "Angul Papatya", "Tulip", "saksı", ""]
    assert value(spark, given, text.detect_category) == ["Gül", "Gül", "Lale", "Karma/Diğer", "Karma/Diğer"]


def test_name_contains_is_false_without_text(spark):
    assert value(spark, ["Red ROSE", "", None], lambda c: text.name_contains(c, "rose")) == [True, False, False]


def test_slugs(spark):
    assert value(spark, ["Büyük Çarşı Iş"], text.site_slug_underscore) == ["buyuk_carsi_is"]
    assert value(spark, ["Büyük  Çarşı"], text.site_slug_compact) == ["buyukcarsi"]
    assert value(spark, ["--A b!!c-"], text.name_slug) == ["a-b-c"]


def test_date_part_and_list(spark):
    assert value(spark, ["2025-11-04T10:00:00Z", "2025-11-04", "soon", None], text.date_part) == [
        date(2025, 11, 4), date(2025, 11, 4), None, None]
    assert value(spark, [["a", None, "b"], []], text.joined_list, "array<string>") == ["a, None, b", ""]


def test_fold_column_names_only_lower_case(spark):
    df = spark.createDataFrame([(1, 2)], "`şehir_ığüöç` int, `Şube` int")
    assert text.fold_column_names(df).columns == ["sehir_iguoc", "Şube"]


@pytest.mark.parametrize("which,given,expected", [
    ("last", ["1.299,90 TL 999,90 TL", "999", "yok", None, "1,299,90", "..."], [999.9, 999.0, 0.0, 0.0, 1.299, 0.0]),
    ("first", ["1.299,90 TL 999,90 TL", "TL"], [1299.9, 0.0]),
    ("strip", ["₺ 1.299,90 TL", "12 34,5", ""], [1299.9, 1234.5, 0.0]),
])
def test_parse_price(spark, which, given, expected):
    assert value(spark, given, lambda c: money.parse_price(c, which)) == expected


def test_parse_price_unknown_rule():
    with pytest.raises(ValueError):
        money.parse_price(F.lit("1"), "middle")


def test_money_display_round_trip(spark):
    assert value(spark, [1234.5, None], lambda c: money.format_money(c), "double") == ["₺1,234.50", ""]
    assert value(spark, [1234.5, None], lambda c: money.format_money(c, "suffix"), "double") == ["1,234.50₺", "N/A"]
    assert value(spark, ["1,234.50₺", "N/A"], money.parse_money) == [1234.5, None]


def test_urls_and_ids(spark):
    base = F.lit("https://x.example")
    assert value(spark, ["/a", "a", "http://y/b", "", None], lambda c: web.absolute_url(c, base)) == [
        "https://x.example/a", "https://x.example/a", "http://y/b", "", ""]
    assert value(spark, ["https://x/p/red rose?id=1", "", "///"], lambda c: web.product_id_from_url(
        c, F.lit("s"), F.lit(7))) == ["s_red_rose_id_1", "s_7", "s_7"]
    assert value(spark, ["/red-rose-123", "plain", "x-", ""], lambda c: web.product_id_from_href(c, F.lit(3))) == [
        "123", "plain", "product_3", "product_3"]
    assert value(spark, ["https://WWW.Shop.example:80/x"], web.url_host) == ["shop.example"]


def test_digest_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), ("a", "a"), (None, None)], "x string, y string")
    assert df.select(*keys.row_digest(df)).distinct().count() == 4


def test_business_key_ignores_amount_and_absent_columns(spark):
    a = spark.createDataFrame([(1, "c", 5.0)], "order_id long, city string, order_amount double")
    b = spark.createDataFrame([(1, "c", None)], "order_id long, city string, rider_id long")
    assert one(a.select(*keys.business_key(a))) == one(b.select(*keys.business_key(b)))


def test_run_slots(spark):
    given = [datetime(2025, 1, 1, 7, 5), datetime(2025, 1, 1, 7, 11), datetime(2025, 1, 1, 22, 0), None]
    got = value(spark, given, clock.classify_run, "timestamp")
    assert [tuple(r) for r in got] == [
        (True, False, "10:05", 18), (False, True, "10:11", 18), (False, True, "01:00", 18), (False, False, None, 18)]


def test_ranges():
    as_of = date(2025, 3, 1)
    assert clock.preset_range("today", as_of) == (as_of, as_of)
    assert clock.preset_range("last_7_days", as_of) == (date(2025, 2, 22), as_of)
    assert clock.preset_range("all_time", as_of) == (date(2020, 1, 1), as_of)
    start, end = date(2025, 2, 1), date(2025, 2, 10)
    assert clock.comparison_range(start, end, "previous_period") == (date(2025, 1, 22), date(2025, 1, 31))
    assert clock.comparison_range(start, end, "previous_month") == (date(2025, 1, 2), date(2025, 1, 11))
    assert clock.comparison_range(start, end, "previous_year") == (date(2024, 2, 2), date(2024, 2, 11))


def test_other_days_keep_undated_rows(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 1, 2),), (None,)], "order_created_date_tr date")
    assert df.filter(filters.not_on_day("2025-01-01")).count() == 2


MORNING = [
    ("kept: inside", "2025-11-04T07:59:59Z", None, None, True),
    ("own offset, no conversion", "2025-11-04T07:00:00-09:00", None, None, True),
    ("hour 8 is out", "2025-11-04T08:00:00", None, None, False),
    ("date only is midnight", "2025-11-04", None, None, True),
    ("other day", "2025-11-03T05:00:00", None, None, False),
    ("no parse, plain date is today", "2025-11-04T99:00", None, "2025-11-04", True),
    ("no parse, created date text differs", "2025-11-04T99:00", None, None, False),
    ("next field is used when empty", "", "2025-11-04T03:00:00", None, True),
    ("no text at all", None, None, "2025-11-04", True),
    ("impossible date", "2025-13-04T03:00:00", None, "2025-11-04", True),
]


def test_morning_filter(spark):
    df = spark.createDataFrame([m[:4] for m in MORNING],
                               "name string, order_created_date string, created_at string, order_created_date_tr string")
    kept = {r.name for r in filters.morning_filter(df, "2025-11-04").collect()}
    assert kept == {m[0] for m in MORNING if m[4]}


def test_morning_filter_drops_non_text_time(spark):
    df = spark.createDataFrame([(5,)], "timestamp long")
    assert filters.morning_filter(df, "2025-11-04").count() == 0


HTML = """<div class="a card"><p id="t">x <b>y</b></p><img src="i"><a href="/1">one</a></div>
<section><div class="card"><span data-price="3" class="now-price">9</span></div></section><script>var s = "<p>no</p>"</script>"""


def test_selectors_of_one_page(spark):
    page = spark.createDataFrame([(HTML,)], "html string").select(markup.visible(F.col("html")).alias("html"))
    count = lambda selector: page.select(F.size(F.coalesce(markup.find_all(F.col("html"), selector), F.array()))).first()[0]
    text = lambda selector: page.select(markup.text_of(markup.inner(markup.find_first(F.col("html"), selector)))).first()[0]
    assert count("article, .card") == 2 and count("section div.card") == 1
    assert count("p") == 1  # text inside scripts is no markup
    assert text("#t") == "x y" and text("[class*=price]") == "9"
    assert text('[data-price="3"]') == "9" and text('[data-price="4"]') is None
    assert page.select(markup.attribute(markup.find_first(F.col("html"), "a[href]"), "href")).first()[0] == "/1"


def test_target_date_is_local():
    now = datetime(2025, 11, 4, 22, 30, tzinfo=timezone.utc)
    assert clock.target_date(now) == "2025-11-05" and clock.target_date(now, days_back=1) == "2025-11-04"
    assert clock.target_date(now, "2025-10") == "2025-10"
