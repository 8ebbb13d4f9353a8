"""Product page rules on hand-written HTML fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwatch.plans import capture
from shelfwatch.sources import pages as Pg

FULL = """<html><body>
<h1 class="product-title">Queso curado de oveja Montalba</h1>
<p class="buy-box__active-price">6,45 €</p>
<p class="buy-box__price-per-unit">(12,90 €/PIEZA)</p>
<span class="breadcrumb-item__link">Quesos, embutidos y fiambres</span>
<span class="breadcrumb-item__link">Quesos</span>
<span class="product_details_promotion_description">Ahorra 20% en la 2ª unidad</span>
</body></html>"""

PAGES = [
    (1, "https://shop.example/quesos/p/55021", FULL),
    (2, "https://shop.example/x/p/2", FULL.replace('<p class="buy-box__active-price">6,45 €</p>', "")),
    (3, "https://shop.example/x/p/3", FULL.replace("Queso curado de oveja Montalba", "Caramelos")),
    (4, "https://shop.example/x/p/4", FULL.replace("Montalba", "Nestlé")),
    (5, "https://shop.example/x/p/5", FULL.replace("6,45 €", "1.234,56 €")),
    (6, "https://shop.example/x/p/6", FULL.replace('<span class="breadcrumb-item__link">Quesos</span>', "")
        .replace('<span class="breadcrumb-item__link">Quesos, embutidos y fiambres</span>', "")),
    (7, "https://shop.example/x/p/7", FULL.replace("Ahorra 20% en la 2ª unidad", "2x1")),
    (8, "https://shop.example/x/p/8", FULL.replace("Queso curado de oveja Montalba",
                                                   "Queso, de oveja\n  Montalba &amp; Hijos")),
    (9, "https://shop.example/x/p/9", FULL.replace('class="product-title"', 'class="h1 product-title big"')),
]


def fields(spark):
    df = spark.createDataFrame(PAGES, Pg.PAGE_SCHEMA)
    return {r.page_id: r for r in Pg.extract_fields(df, Pg.SHOP_RULES, run_date="2024-01-01").collect()}


def test_complete_page(spark):
    r = fields(spark)[1]
    assert (r.product_id, r.product, r.brand, r.price, r.unit_price, r.units, r.discount, r.date) == (
        "55021", "Queso curado de oveja Montalba", "Montalba", 6.45, 12.9, "€/PIEZA)", 20.0,
        dt.date(2024, 1, 1))
    assert r.categories == "['Quesos. embutidos y fiambres', 'Quesos']"


def test_edge_pages(spark):
    f = fields(spark)
    assert f[2].price is None
    assert (f[3].product, f[3].brand) == ("Caramelos", None)
    assert f[4].brand == "Nestlé"
    assert f[5].price == 234.56                      # historical rule on thousands
    assert f[6].categories is None
    assert f[7].discount is None
    assert (f[8].product, f[8].brand) == ("Queso. de oveja  Montalba & Hijos", "Montalba")
    assert f[9].product == "Queso curado de oveja Montalba"


def test_capture_splits_incomplete_records(spark):
    df = spark.createDataFrame(PAGES, Pg.PAGE_SCHEMA)
    ok, bad = capture.capture_products(df, Pg.SHOP_RULES, run_date="2024-01-01")
    reasons = {r.page_id: r.reject_reason for r in bad.collect()}
    assert reasons == {2: "price", 3: "brand"}
    assert ok.count() == 7 and set(capture.RECORD_COLS) <= set(ok.columns)


def test_work_queue_from_sitemap(spark):
    xml = ("<urlset><url><loc>https://shop.example/tonic/p/740512</loc></url>"
           "<url><loc> https://shop.example/help </loc></url>"
           "<url><loc>https://shop.example/agua/p/1001</loc></url></urlset>")
    q = capture.queue_from_sitemap(spark.createDataFrame([(xml,)], "xml string")).orderBy("index").collect()
    assert [tuple(r) for r in q] == [("740512", "https://shop.example/tonic/p/740512", 0),
                                     ("1001", "https://shop.example/agua/p/1001", 1)]
    assert capture.pending(capture.queue_from_sitemap(spark.createDataFrame([(xml,)], "xml string")), 0).count() == 1


def test_pages_of_one_file_are_parsed_by_many_tasks(spark, tmp_path):
    html = '<!-- <h1>no</h1> --><h1>Big Thing {0}</h1><nav><li>A</li><li>B<!-- , --></li></nav><p class="buy-box__active-price">{0},50</p>'
    rows = [(i, f"https://shop.example/p/{i}", html.format(i)) for i in range(200)]
    spark.createDataFrame(rows, Pg.PAGE_SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    fields = Pg.extract_fields(spark.read.parquet(str(tmp_path / "in")), Pg.GENERIC_RULES)
    got = fields.select("page_id", "product", "brand", "price", "categories", F.spark_partition_id().alias("task")).collect()
    assert sorted(tuple(r)[:5] for r in got) == [(i, f"Big Thing {i}", "Thing", i + 0.5, "['A', 'B']") for i in range(200)]
    assert len({r.task for r in got}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
