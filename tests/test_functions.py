"""Column functions: text clean-up, price/brand/category rules, URL ids."""

from pyspark.sql import functions as F

from shelfwatch.functions import numeric as nm, text as tx


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_first_category_parses_python_list_repr(spark):
    cases = {
        "['a. b', 'c']": "a. b",
        "[\"d'or\", 'x']": "d'or",
        "['a\\'b\"c', 'x']": "a'b\"c",
        "[]": None,
        "[a. b, c]": None,
        None: None,
    }
    for text, want in cases.items():
        assert one(spark, tx.first_category, text) == want, text


def test_encode_list_round_trips_through_first_category(spark):
    df = spark.createDataFrame([(["d'or", "x"],), (["a. b", "c"],), (['a\'b"c', "z"],)], "arr array<string>")
    out = df.select(tx.encode_list("arr").alias("e")).select("e", tx.first_category("e").alias("f")).collect()
    assert [r.e for r in out] == ["[\"d'or\", 'x']", "['a. b', 'c']", "['a\\'b\"c', 'z']"]
    assert [r.f for r in out] == ["d'or", "a. b", 'a\'b"c']


def test_brand_is_second_capitalised_word_unicode_aware(spark):
    assert one(spark, tx.brand_token, "Chocolate con leche Nestlé 100 g") == "Nestlé"
    assert one(spark, tx.brand_token, "Cereales Kellogg's") == "Kellogg"
    assert one(spark, tx.brand_token, "Caramelos") is None          # one word: no brand
    assert one(spark, tx.brand_token, "Queso\tde oveja, Montalba\n") == "Montalba"


def test_clean_text_drops_controls_commas_and_edge_whitespace(spark):
    assert one(spark, tx.clean_text, "  Azúcar, blanco\r\n\t ") == "Azúcar. blanco"
    assert one(spark, tx.trim_all, " \t x y \n") == "x y"


def test_price_patterns(spark):
    assert one(spark, tx.first_match_price, "2,60 €") == 2.6
    assert one(spark, tx.first_match_price, "sin precio") is None
    # default rule keeps the historical behaviour on thousands (D4) ...
    assert one(spark, tx.first_match_price, "1.234,56 €") == 234.56
    # ... the thousands-aware rule reads the whole number
    assert one(spark, lambda c: tx.first_match_price(c, tx.PRICE_PATTERN_THOUSANDS), "1.234,56 €") == 1234.56


def test_unit_label_and_discount(spark):
    assert one(spark, tx.unit_label, "(17,33 €/KILO)") == "€/KILO)"
    assert one(spark, lambda c: tx.unit_label(c, strip_paren=True), "(2,47 €/100 ML.)") == "€/100 ML."
    assert one(spark, tx.unit_label, "17,33") is None
    assert one(spark, tx.discount_percent, "Ahorra 20% en la 2ª unidad") == 20.0
    assert one(spark, tx.discount_percent, "2x1") is None


def test_url_ids(spark):
    url = "https://shop.example/drinks/lemonade/p/740512"
    assert one(spark, tx.url_last_segment, url) == "740512"
    assert one(spark, tx.url_last_segment, "http://x.example/en/825?page=2#top") == "825"
    assert one(spark, tx.url_last_segment, "http://x.example/en/853/") is None
    assert one(spark, tx.url_digits_tail, url) == "740512"
    # an earlier digit makes the two rules differ
    assert one(spark, tx.url_digits_tail, "https://shop2.example/p/12") == "2.example/p/12"
    assert one(spark, tx.is_product_url, url) is True
    assert one(spark, tx.is_product_url, "https://shop.example/cola") is False


def test_pct_change_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(2.01, 2.00), (1.0, 3.0), (5.0, 0.0), (5.0, None), (1e30, 1.0)], "a double, b double")
    out = [r.p for r in df.select(nm.pct_change_2dp("a", "b").alias("p")).collect()]
    assert out == [1.0, -67.0, None, None, None]   # 1.005 -> 1.01 -> +1 %; overflow -> null


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "x double")
    assert df.agg(nm.money_sum("x").alias("s")).first().s == 3.0


def test_html_entities_named_and_numeric(spark):
    cases = {
        "caf&#233; cr&#xE8;me &amp; t&#39;": "café crème & t'",
        "&amp;#39; and &amp;lt;": "&#39; and &lt;",
        "&#128512;&#0;": "\U0001F600&#0;",
        "plain": "plain",
        None: None,
    }
    for text, want in cases.items():
        assert one(spark, tx.decode_entities, text) == want, text


def test_money_with_more_than_two_decimals_keeps_them(spark):
    df = spark.createDataFrame([(0.125,), (0.125,), (None,)], "x double")
    assert df.agg(nm.money_sum("x").alias("s")).first().s == 0.25
    pairs = spark.createDataFrame([(0.125, 0.124), (0.004, 0.002), (2.01, 2.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    assert [r.p for r in pairs.select(nm.pct_change_2dp("a", "b").alias("p")).collect()] == [1.0, 100.0, 1.0, None, None]
