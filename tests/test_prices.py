"""Price snapshots, benchmarks, messages and pages on hand-made rows."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stallmetrics import schemas
from stallmetrics.functions import markup
from stallmetrics.operators import benchmark, pages, pricing, reports
from stallmetrics.sources import readers
from tests.conftest import one, rows

T1, T2 = datetime(2025, 1, 1), datetime(2025, 1, 2)


def products(spark, data):
    full = [(s, f"Site {s}", p, f"name {p}", float(price), f"/{p}", cat, T1) for s, p, price, cat in data]
    return spark.createDataFrame(full, schemas.PRODUCT_ROWS)


@pytest.fixture(scope="module")
def prev(spark):
    return products(spark, [("a", "1", 10, "x"), ("a", "2", 20, "x"), ("b", "1", 5, "y"), ("b", "9", 1, "y")])


@pytest.fixture(scope="module")
def cur(spark):
    return products(spark, [("a", "1", 12.5, "x"), ("a", "2", 20, "x"), ("b", "1", 4, None), ("c", "1", 7, "z")])


def test_price_changes(prev, cur):
    assert rows(pricing.price_changes(prev, cur), "site_id", "product_id", "old_price", "new_price", "price_diff") == [
        ("a", "1", 10.0, 12.5, 2.5), ("b", "1", 5.0, 4.0, -1.0)]
    assert pricing.price_changes(cur, cur).count() == 0
    assert pricing.price_changes(prev, cur, 2).count() == 1


def test_price_comparison(spark, cur):
    old = products(spark, [("a", "1", 10, "x"), ("a", "2", 0, "x")])
    got = {(r.site_id, r.product_id): (r.old_price, r.price_diff, r.change_pct, r.category)
           for r in pricing.price_comparison(cur, old).collect()}
    assert got == {("a", "1"): (10.0, 2.5, 25.0, "x"), ("a", "2"): (0.0, 20.0, 0.0, "x"),
                   ("b", "1"): (None, None, None, "-"), ("c", "1"): (None, None, None, "z")}
    sheet = {r.product_name + r.site_name: (r.old_price, r.price_diff, r.change_pct)
             for r in pricing.comparison_sheet(pricing.price_comparison(cur, old)).collect()}
    assert sheet["name 1Site a"] == ("10.0", "2.50", "25.00%") and sheet["name 1Site c"] == ("-", "-", "-")


def test_snapshot_keeps_the_last_write(spark):
    df = products(spark, [("a", "1", 1, "x"), ("a", "1", 2, "x")]).withColumn("pos", F.col("price"))
    assert one(pricing.snapshot_of(df, ["pos"]), "price") == (2.0,)


def test_upsert_keeps_first_seen(spark, prev, cur):
    dim = pricing.product_rows(prev)
    later = cur.withColumn("timestamp", F.lit(T2)).withColumn("site_name", F.lit("renamed"))
    got = {(r.site_id, r.product_id): r for r in pricing.upsert_products(dim, later).collect()}
    assert len(got) == 5
    kept = got["a", "1"]
    assert (kept.site_name, kept.first_seen, kept.last_seen) == ("Site a", T1, T2)
    assert got["b", "1"].category == "Unknown" and got["b", "9"].last_seen == T1 and got["c", "1"].first_seen == T2


def test_volatility(spark, prev):
    hist = spark.createDataFrame([("a", "1", 10.0, date(2025, 1, 1)), ("a", "1", 13.5, date(2025, 1, 9)),
                                  ("a", "2", 20.0, date(2025, 1, 9)), ("b", "1", 1.0, date(2024, 1, 1)),
                                  ("b", "1", 9.0, date(2025, 1, 9))], "site_id string, product_id string, price double, date date")
    assert rows(pricing.volatile_products(prev, hist, "2025-01-10")) == [("name 1", "Site a", 10.0, 13.5, 3.5)]


def test_fallback_only_for_missing_sites(spark, prev, cur):
    spare = products(spark, [("a", "7", 1, "x"), ("d", "8", 1, "x"), ("d", "9", 1, "x")])
    got = pricing.with_fallback(cur, spare, "NAME 8")
    assert got.count() == 5 and got.filter("site_id = 'd'").first().product_id == "8"


def test_visibility(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(3)] + [("c", 0), ("d", 0), ("e", 0)], "site_id string, position int")
    caps = spark.createDataFrame([("a", 2), ("c", 4), ("d", 0), ("e", None)], "site_id string, cap int")
    for per_task in (1, 3, 24):
        got = pricing.visibility_label(df, caps, per_task=per_task).groupBy("site_id", "visibility").count()
        assert rows(got) == [("a", "Gizli/ekstra", 3), ("a", "Görünür", 2), ("b", "-", 3), ("c", "Görünür", 1),
                             ("d", "-", 1), ("e", "-", 1)]


def test_report_blocks_hold_every_row(spark):
    df = spark.createDataFrame([("b" if i % 3 else "a", str(i)) for i in range(25)], "site_id string, product_id string")
    got = pricing.report_blocks(df, ["site_id", "product_id"], 10).orderBy("block", "place")
    want = sorted((("b" if i % 3 else "a", str(i)) for i in range(25)))
    assert [(r.site_id, r.product_id) for r in got.collect()] == want
    assert [(r.block, r.place) for r in got.collect()] == [(i // 10 + 1, i % 10 + 1) for i in range(25)]


def test_products_are_upserted_once_per_key(spark, prev):
    twice = prev.unionByName(prev.withColumn("product_name", F.lit("z")))
    dim = pricing.upsert_products(pricing.product_rows(prev), twice)
    assert dim.count() == prev.count()


def test_benchmarks_use_positive_prices_and_all_rows(spark):
    df = products(spark, [("a", "1", 0, "x"), ("a", "2", 10, "x"), ("a", "3", 20.01, "y"), ("b", "1", 0, "x")])
    assert rows(benchmark.bench_by_site(df)) == [("a", "Site a", 3, 15.01, 10.0, 20.01)]  # 15.005 rounds up
    assert rows(benchmark.bench_by_category(df)) == [("x", 2, 5.0), ("y", 1, 20.01)]
    assert rows(benchmark.bench_category_levels(df)) == [
        ("x", "a", 0, 2, 5.0), ("x", None, 1, 2, 5.0), ("y", "a", 0, 1, 20.01), ("y", None, 1, 1, 20.01)]
    assert rows(benchmark.category_site_pivot(df, ["a", "b"])) == [("x", 5.0, 0.0), ("y", 20.01, 0.0)]
    assert one(benchmark.mean_of_site_means(df)) == (15.01,)
    assert one(benchmark.mean_of_site_means(df.limit(0))) == (0.0,)


def test_published_example_of_site_statistics(spark):
    """30 products with the published mean, minimum and maximum of one site."""
    rest = [round((893.73 * 30 - 449.99 - 2049.00) / 28, 2)] * 28
    df = products(spark, [("s", str(i), p, "x") for i, p in enumerate([449.99, 2049.00, *rest])])
    assert one(benchmark.bench_by_site(df))[2:] == (30, 893.73, 449.99, 2049.0)


SCRAPE = {"scrape_date": "2025-01-01T00:00:00Z", "total_sites": 2, "sites": [
    {"site_id": "a", "site_name": "A", "success": True, "products": [
        {"id": "1", "name": "n", "price": 3.5, "category": "x"}, {"id": "1", "name": "n2", "price": 4.5}]},
    {"site_id": "b", "site_name": "B", "success": False, "error": "boom", "products": []}]}
SNAPSHOT = {"last_update": "2025-01-01T00:00:00Z", "sites": {
    "a": {"name": "A", "products": {"a_1": {"name": "n", "price": 3.5, "url": "/1", "category": "x"},
                                    "a_2": {"name": "m", "price": 1, "url": "/2"}}}, "b": {"name": "B", "products": {}}}}
FLAT = {"1": {"name": "n", "price": 3.5, "url": "/1"}, "2": {"name": "m", "price": 1.25, "url": "/2"}}
REPORT = {"date": "2025-01-01T00:00:00Z", "price_analysis": {"by_site": {
    "A": {"product_count": 3, "avg_price": "893.73", "min_price": "449.99", "max_price": "2049.00"}}}}
SITES = {"sites": [{"id": "a", "name": "A", "enabled": True, "selectors": {"product_box": ".c"}},
                   {"id": "b", "name": "B", "enabled": False}]}


def written(tmp_path, doc):
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(doc, indent=1))
    return str(path)


def test_scrape_source(spark, tmp_path):
    scraped = readers.flatten_scrape(readers.read_scrape(spark, written(tmp_path, SCRAPE)))
    assert rows(scraped, "site_id", "position", "product_id", "price") == [
        ("a", 0, "1", 3.5), ("a", 1, "1", 4.5), ("b", None, None, None)]
    assert one(benchmark.run_summary(scraped)) == (2, 1, 2)
    assert one(benchmark.failed_sites(scraped)) == ("B", "boom")
    assert one(pricing.snapshot_of(benchmark.successful(scraped), ["position"]), "price") == (4.5,)


def test_snapshot_sources(spark, tmp_path):
    nested = readers.flatten_snapshot(readers.read_snapshot(spark, written(tmp_path, SNAPSHOT)))
    assert rows(nested, "site_id", "product_id", "price", "category") == [("a", "a_1", 3.5, "x"), ("a", "a_2", 1.0, None)]
    flat = readers.flatten_flat_snapshot(readers.read_flat_snapshot(spark, written(tmp_path, FLAT)), "s", "S")
    assert rows(flat, "site_id", "product_id", "price") == [("s", "1", 3.5), ("s", "2", 1.25)]


def test_report_and_site_sources(spark, tmp_path):
    report = readers.flatten_benchmark(readers.read_benchmark(spark, written(tmp_path, REPORT)))
    assert one(report.drop("timestamp")) == ("A", 3, 893.73, 449.99, 2049.0)
    assert one(readers.read_sites(spark, written(tmp_path, SITES)), "id") == ("a",)
    assert readers.read_sites(spark, written(tmp_path, SITES), only_enabled=False).count() == 2


def test_missing_source_is_empty(spark, tmp_path):
    missing = str(tmp_path / "none")
    assert readers.flatten_snapshot(readers.read_snapshot(spark, missing)).count() == 0
    assert readers.flatten_flat_snapshot(readers.read_flat_snapshot(spark, missing)).count() == 0
    assert readers.read_order_items(spark, missing).columns == schemas.ORDER_ITEMS.fieldNames()


def test_change_messages(prev, cur):
    changes = pricing.price_changes(prev, cur)
    lines = rows(reports.change_lines(changes), "line")
    assert lines == [("📈 *name 1*: 10.00₺ → 12.50₺ (+2.50₺) </1|Ürün>",), ("📉 *name 1*: 5.00₺ → 4.00₺ (-1.00₺) </1|Ürün>",)]
    assert one(reports.change_header(changes))[:2] == (2, 2)
    digest = reports.change_digest(changes).filter("site_id = 'a'").first()
    assert digest.heading == "*🏪 Site a* - 1 değişiklik"
    assert digest.message == "*name 1*\n• Eski: 10.00₺ → Yeni: 12.50₺\n• Fark: 📈 +2.50₺\n</1|Ürüne Git>"


def test_batches_hold_every_change_once(spark):
    old = products(spark, [("hot" if i % 3 else f"s{i}", str(i), 1, "x") for i in range(103)])
    new = old.withColumn("price", F.col("price") + 1)
    batches = reports.batch_messages(pricing.price_changes(old, new))
    assert rows(batches, "change_count").count((5,)) == 20 and batches.count() == 21
    lines = [line for r in batches.orderBy("message_no").collect() for line in r.message.split("\n")]
    assert len(lines) == 103 == len(set(lines))
    keys = sorted(("hot" if i % 3 else f"s{i}", str(i)) for i in range(103))
    assert [line.split("*")[1] for line in lines] == [f"name {product}" for _, product in keys]
    digest = reports.change_digest(pricing.price_changes(old, new), 10).filter("site_id = 'hot'")
    assert sorted(r.change_count for r in digest.collect()) == [8, 10, 10, 10, 10, 10, 10]


def test_end_of_day_digest_only_at_18_local(spark, cur):
    at = lambda hour: reports.end_of_day_digest(cur, F.lit(datetime(2025, 1, 1, hour)))
    assert at(15).count() == 3 and at(14).count() == 0


PAGE = """<html><head><script type="application/ld+json">{"a": 1}</script>
<script type='application/ld+json'> {broken </script></head><body>
<article class="x"><h3> Red <b>Rose</b> </h3><div class="price">1.299,90 TL 999,90 TL</div><a href="/p/red-rose-12">go</a></article>
<article class="x"><h3>No price</h3><div class="price">yok</div></article>
<article class="x"><div class="price">5 TL</div><a href="https://other/9">go</a></article>
<nav><a href="/orkide">Orkide &amp; Saksı</a><a href="/orkide">Orkide again</a><a href="https://elsewhere/x">Orkide</a>
<a href='/best'><i>Çok  Satanlar</i></a></nav></body></html>"""


def page_frame(spark, html):
    return spark.createDataFrame([(1, "https://www.shop.example/list?page=1", html)], schemas.PAGES)


def test_extract_products(spark):
    site = spark.createDataFrame([("s", "Shop", "https://shop.example", (".card, article", "h2, h3", ".fiyat, .price", "a"))],
                                 "id string, name string, url string, selectors struct<product_box string, product_name string,"
                                 " product_price string, product_link string>")
    got = pages.extract_products(page_frame(spark, PAGE), site)
    assert one(got, "product_id", "product_name", "price", "url", "category") == (
        "s_red-rose-12", "Red Rose", 999.9, "https://shop.example/p/red-rose-12", "Gül")
    first = pages.extract_products(page_frame(spark, PAGE), site, price_rule="first", tasks=2)
    assert one(first, "price") == (1299.9,)


def found(spark, html, selectors):
    df = spark.createDataFrame([(html,)], "html string").select(markup.visible(F.col("html")).alias("html"))
    boxes = df.select(F.explode(markup.find_all(F.col("html"), selectors)).alias("e")).select("e.tag", "e.content")
    return [(r["tag"], r["text"]) for r in boxes.select("tag", markup.text_of(F.col("content")).alias("text")).collect()]


def texts(spark, html, selectors):
    return [t for _, t in found(spark, html, selectors)]


def test_elements_end_where_their_tags_balance(spark):
    html = """<div class="card">a<div>b</div><DIV>c</DIV ></div>x<div class='card big'>d<br><img src="a.png"/>e</div>
      <div class="cardboard">no</div><!-- <div class="card">gone</div> --><script>'<div class="card">'</script><div class=card>f</div>"""
    assert texts(spark, html, ".card") == ["abc", "de", "f"]
    assert texts(spark, html, "section, .none, div.big") == ["de"]
    assert texts(spark, '<p class="c">1<p class="c">2<div class="c">3', ".c") == ["1", "2", "3"]
    assert texts(spark, '<div class="o c">1<div class="c">2</div>3</div>4', ".c") == ["123", "2"]
    assert texts(spark, "<ul><li>1<li>2</ul>", "li") == ["1", "2"]
    assert texts(spark, "", ".c") == [] and texts(spark, "<", "a") == []
    long = "<div class='c'>" + "<div>x</div>" * 3000 + "</div>y"
    assert texts(spark, long, ".c") == ["x" * 3000]


@pytest.mark.parametrize(("selector", "want"), [
    ("#one", ["1"]), ("[data-x]", ["1", "2", "3"]), ('[data-x="b c"]', ["2"]), ('[data-x*="c"]', ["2", "3"]), ('[data-x^="b"]', ["2"]),
    ('[data-x$="cd"]', ["3"]), ("b[data-x]", ["3"]), ("B", ["3"]), (".k", ["1", "2"]), ("i.k[data-x]", ["1", "2"]), ("u i", ["2"]), ("*.k", ["1", "2"])])
def test_selectors(spark, selector, want):
    html = """<i id="one" class="k" data-x>1</i><u><i class='j k' data-x='b c'>2</i></u><b DATA-X=cd>3</b><i class="kk">4</i>"""
    assert texts(spark, html, selector) == want


def test_characters_and_attributes(spark):
    assert texts(spark, "<b> &ouml;&amp;#39; &#252;&#x131;&#39;&nope; &lt;i&gt; &#xD800; </b>", "b") == ["ö&#39; üı'&nope; <i> &#xD800;"]
    df = spark.createDataFrame([("<a class=x HREF = '/p?a=1&amp;b=2'>t",), ("<a data-href='/n'>",), ("<a href=/q>",)], "e string")
    assert [r[0] for r in df.select(markup.attribute(F.col("e"), "href")).collect()] == ["/p?a=1&b=2", None, "/q"]


@pytest.mark.parametrize("selector", ["ul > li", "li:not(.x)", "li + li", "a ~ b"])
def test_unsupported_selectors_are_errors(spark, selector):
    with pytest.raises(ValueError, match="not supported"):
        markup.find_all(F.col("html"), selector)


def test_cards_need_no_python_worker(spark):
    site = spark.createDataFrame([("s", "Shop", "https://shop.example", (".c", "b", "i"))],
                                 "id string, name string, url string, selectors struct<product_box string, product_name string, product_price string>")
    plan = pages.extract_products(page_frame(spark, PAGE), site)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_extract_json_ld_drops_broken_blocks(spark):
    assert one(pages.extract_json_ld(page_frame(spark, PAGE)), "block_no", "json") == (0, '{"a": 1}')
    assert pages.extract_json_ld(page_frame(spark, None)).count() == 0


def test_discover_categories(spark):
    df = page_frame(spark, PAGE)
    assert rows(pages.discover_categories(df), "rank", "category", "url") == [
        (0, "Orkide & Saksı", "https://www.shop.example/orkide")]
    found = pages.discover_categories(df, ["orkide", "satanlar"], ["Çok  Satanlar", "Orkide", "Orkide &"])
    assert rows(found, "rank", "category") == [(0, "Çok  Satanlar"), (1, "Orkide & Saksı"), (2, "Orkide & Saksı")]
    everything = pages.discover_categories(df, ["orkide", "satanlar"], ["nothing"])
    assert rows(everything, "rank", "category") == [(0, "Orkide & Saksı"), (1, "Çok  Satanlar")]
    listed = [("Kutu", "https://x/kutu")]
    more = pages.discover_categories(df, ["orkide"], ["nothing"], configured=listed)
    assert rows(more, "rank", "category", "url") == [(0, "Kutu", "https://x/kutu"), (1, "Orkide & Saksı", "https://www.shop.example/orkide")]
    assert rows(pages.discover_categories(df, ["orkide"], ["orkide"], configured=listed), "category") == [("Orkide & Saksı",)]
    # Without any link on the home page the configured list stays as it is.
    assert rows(pages.discover_categories(df, ["zzz"], ["x"], configured=listed), "rank", "category") == [(0, "Kutu")]
    assert pages.discover_categories(df, ["zzz"], ["x"]).count() == 0
