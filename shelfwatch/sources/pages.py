"""Product pages as a table: ``(page_id, url, html)`` rows, parsed with
column expressions (no per-row parser, no network client).

A ``PageRules`` maps each product field to an HTML element (tag, optional CSS
class, optional enclosing element). Elements are matched by their tags' depth
in JVM expressions (``functions.text.html_inner``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.functions import text as tx

Rule = tuple  # (tag, css_class or None[, enclosing tag])


@dataclass(frozen=True)
class PageRules:
    title: Rule
    price: Rule
    unit_price: Rule
    categories: Rule
    discount: Rule


# Elements of the supermarket product page, as (tag, CSS class).
SHOP_RULES = PageRules(
    title=("h1", "product-title"),
    price=("p", "buy-box__active-price"),
    unit_price=("p", "buy-box__price-per-unit"),
    categories=("span", "breadcrumb-item__link"),
    discount=("span", "product_details_promotion_description"),
)

# Plain article pages: heading as title, navigation items as categories.
GENERIC_RULES = PageRules(
    title=("h1", None),
    price=("p", "buy-box__active-price"),
    unit_price=("p", "buy-box__price-per-unit"),
    categories=("li", None, "nav"),
    discount=("span", "product_details_promotion_description"),
)

PAGE_SCHEMA = "page_id bigint, url string, html string"
LINK_PATTERN = r"""(?is)<a\s[^>]*?href\s*=\s*"([^"]*)\""""
SITEMAP_LOC_PATTERN = r"(?is)<loc>\s*([^<]*?)\s*</loc>"


def _scope(html: Column, rule: Rule, bare: bool = False) -> Column:
    if len(rule) > 2 and rule[2]:
        return F.coalesce(F.get(tx.html_inner(html, rule[2], bare=bare), 0), F.lit(""))
    return html


def field_texts(html: Column, rule: Rule) -> Column:
    """Visible texts of every element matching ``rule`` (array<string>)."""
    return tx.html_elements(_scope(html, rule), rule[0], rule[1])


def field_text(html: Column, rule: Rule) -> Column:
    return F.get(field_texts(html, rule), 0)


def _spread(pages: DataFrame) -> DataFrame:
    """The pages dealt evenly over the session's shuffle partitions.

    A page costs far more to parse than to read, and a scan is split by bytes
    and row groups: a file that fills a few of them would be parsed by as many tasks."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def extract_fields(pages: DataFrame, rules: PageRules = SHOP_RULES, html_col: str = "html",
                   url_col: str = "url", run_date=None) -> DataFrame:
    """One product record per page (fields null when absent), plus the page columns.

    product_id: last URL path segment; product: cleaned title; brand: second
    capitalised word of the title; price / unit_price: first decimal-comma
    number of their element; units: from the euro sign on; categories: the
    cleaned crumb texts encoded as a list; discount: percent of the promotion
    element; date: ``run_date`` (default: today)."""
    h = F.col(html_col)
    own = [c for c in pages.columns if c != html_col]
    # the elements first, each found once however many fields are read from it, and all made text by one expression
    single = ("title", "price", "unit_price", "discount")

    def found_in(bare: Column) -> Column:
        # what lies in an enclosing element is made bare again, as a text of its own
        inner = [tx.html_inner(_scope(bare, rule, bare=True), rule[0], rule[1], bare=len(rule) < 3 or not rule[2])
                 for rule in [getattr(rules, n) for n in (*single, "categories")]]
        return F.concat(F.array(*[F.get(x, 0) for x in inner[:-1]]), inner[-1])
    texts = F.transform(tx._let(tx.html_bare(h), found_in), lambda x: tx.html_text(x))
    # an optimizer moves filters on the fields in front of a projection, with the elements searched again for each;
    # not in front of a generator, here one of one row
    found = _spread(pages).select(*own, F.explode(F.array(texts)).alias("_texts")).select(
        *own, *[F.get("_texts", i).alias(f"_{n}") for i, n in enumerate(single)],
        F.transform(F.slice("_texts", F.lit(len(single) + 1), F.greatest(F.size("_texts") - len(single), F.lit(0))), lambda x: tx.clean_text(x)).alias("_crumbs"))
    day = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return found.select(
        *own,
        tx.url_last_segment(url_col).alias("product_id"),
        tx.clean_text("_title").alias("product"),
        tx.brand_token("_title").alias("brand"),
        tx.first_match_price("_price").alias("price"),
        F.when(F.size("_crumbs") > 0, tx.encode_list(F.col("_crumbs"))).alias("categories"),
        tx.first_match_price("_unit_price").alias("unit_price"),
        tx.unit_label("_unit_price").alias("units"),
        tx.discount_percent("_discount").alias("discount"),
        day.alias("date"),
    )


def page_links(pages: DataFrame, html_col: str = "html", key_col: str = "page_id") -> DataFrame:
    """Every ``<a href>`` of every page with its position: key, pos, href."""
    links = F.regexp_extract_all(F.col(html_col), F.lit(LINK_PATTERN), 1)
    return pages.select(key_col, F.posexplode(links).alias("pos", "href"))


def sitemap_file_urls(spark: SparkSession, path: str) -> DataFrame:
    """``<loc>`` entries of stored sitemap documents of any size: doc (file),
    block, row, pos, url; ordered by these columns they stand as in the documents.

    The text source reads records that begin behind a ``<loc>``, so a document
    is split over tasks at any place and no task holds more than a block of it
    and one record. What stands before the first ``<loc>`` is a record too; it
    begins with a tag and therefore holds no entry, as a cut-off last one."""
    records = spark.read.option("lineSep", "<loc>").option("recursiveFileLookup", True).text(path).select(
        F.col("_metadata.file_path").alias("doc"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.concat(F.lit("<loc>"), "value").alias("record"))
    locs = F.regexp_extract_all("record", F.lit(SITEMAP_LOC_PATTERN), 1)
    return records.select("doc", "block", "row", F.posexplode(locs).alias("pos", "url"))


def sitemap_urls(sitemap: DataFrame, xml_col: str = "xml", key_col: str | None = None) -> DataFrame:
    """``<loc>`` entries of sitemap documents: doc (``key_col`` or 0), pos, url."""
    locs = F.regexp_extract_all(F.col(xml_col), F.lit(SITEMAP_LOC_PATTERN), 1)
    doc = F.col(key_col) if key_col else F.lit(0).cast("bigint")
    return sitemap.select(doc.alias("doc"), F.posexplode(locs).alias("pos", "url"))
