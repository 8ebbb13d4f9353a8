"""Registered queries over stored tables and mergeable summaries, with their SQL oracles.

These write what they work on to the shared scratch folder, lose jobs on
purpose and carry on, and return what is stored in the end.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import text as tx
from shelfwatch.operators import dml, quality as Qy, stats as St, summaries as Su
from shelfwatch.plans import etl, observations as O, variation_store as VS, warehouse as W
from shelfwatch.plans.capture import capture_products, queue_from_sitemap_files
from shelfwatch.plans.variation import price_table
from shelfwatch.queries import (FENCES_SQL, LOAD_TS, OBS_COLS, OBS_SQL, ORACLE as BASE_ORACLE, RUN_DATE, SHOP_COLS, SHOP_SQL, VARIATION_SQL, _fresh, _ingested, _obs, _pages,
                                _shop_pages, _sql_first, _trimmed, DIGITS, EXISTING_BEFORE, INCOMING_FROM)
from shelfwatch.session import scratch_path, stage_table
from shelfwatch.sources import buckets as B, export as X, pages as Pg, snapshots as Sn, tables as T
from shelfwatch.streaming import queue as Q
from shelfwatch.streaming.ingest import ingest_pages


class _Lost(Exception):
    """Ends a job on purpose."""


def _lose_at(name: str):
    def hook(written: str) -> None:
        if written == name:
            raise _Lost(name)
    return hook


def _losing(run) -> None:
    try:
        run()
    except Exception as e:  # a stream wraps what its batch raises
        if "_Lost" not in f"{type(e).__name__} {e}":
            raise


def q_product_dim_buckets(spark, sf):
    """A stored dimension that lacks every fifth product, merged with the batch bucket by bucket, twice."""
    existing, incoming = O.split_batches(_obs(spark, sf), EXISTING_BEFORE, INCOMING_FROM)
    path = scratch_path(spark, "dim")
    T.create_tables(spark, path, {"producto_dim": B.stored_schema(schemas.PRODUCT_DIM)}, {"producto_dim": [B.BUCKET]})
    path += "/producto_dim"
    for batch in (existing.where(F.col("product_id").cast("int") % 5 != 0), incoming, incoming):
        B.merge_buckets(spark, path, schemas.PRODUCT_DIM, W.latest_products(batch), "product_id", W.PRODUCT_ATTRS, "id_producto", ["product_id"],
                        load_ts=LOAD_TS, buckets=16)
    return B.read_buckets(spark, path, schemas.PRODUCT_DIM).drop("ts_load", B.BUCKET)


def q_load_after_losses(spark, sf):
    """Loads of ever more years, each lost after another table was written; then all years, with the ids that were handed out."""
    base, obs = scratch_path(spark, "wh"), stage_table(_obs(spark, sf), "obs")  # each load reads it three times
    etl.create_warehouse(spark, base, LOAD_TS)
    for until, table in ((1996, "date_dim"), (1997, "producto_dim"), (1998, "precio_dia_agg_norm_fact")):
        _losing(lambda: etl.load_dataset(spark, obs.where(F.year("date") <= until), base, LOAD_TS, on_write=_lose_at(table)))  # noqa: B023
    etl.load_dataset(spark, obs, base, LOAD_TS)
    wh = etl.open_warehouse(spark, base)
    # ids that were handed out twice would join several days or products
    return (wh.fact.join(wh.date_dim.select("id_date", "date"), "id_date").join(wh.product_dim.select("id_producto", "product_id"), "id_producto")
            .select("product_id", "date", "price", "unit_price", "discount", "year"))


def q_variation_by_batches(spark, sf):
    """Price variation kept batch by batch, with late dates in the second one, which is lost and run again."""
    wh, base = _fresh(spark, sf), scratch_path(spark, "variation")
    rows = stage_table(price_table(wh.fact, wh.product_dim, wh.date_dim), "priced")  # read by every batch
    year, held_back = F.year("date"), (F.col("id_producto") % 9 == 0) & (F.year("date") == 1996)
    batches = [rows.where((year <= 1997) & ~held_back), rows.where(year.between(1998, 1999) | held_back), rows.where(year >= 2000)]
    VS.add_batch(spark, base, batches[0], 0, buckets=16)
    _losing(lambda: VS.add_batch(spark, base, batches[1], 1, on_write=_lose_at("variation")))
    for i in (1, 2):
        VS.add_batch(spark, base, batches[i], i)
    return VS.read_variation(spark, base)


def q_queue_capture(spark, sf):
    """Shop pages captured for a queue of every product but each seventh, with a loss between write and purge; records, rejects and what is open."""
    base, src, pages = scratch_path(spark, "queue"), scratch_path(spark, "pages-in"), _shop_pages(spark, sf)
    queue = pages.select(F.col("page_id").cast("string").alias("id_producto"), F.col("url").alias("url_product"), (F.col("page_id") - 1).alias("index"))
    Q.create_queue(queue.where(F.col("index") % 7 != 3), base)
    pages.where("page_id % 11 <> 5").repartitionByRange(3, "page_id").write.parquet(src)  # some have no page yet
    for on_write in (_lose_at("records"), None):
        _losing(lambda: Q.process_queue(spark, base, src, RUN_DATE, Pg.SHOP_RULES, max_files_per_trigger=1, load_ts=LOAD_TS, on_write=on_write))  # noqa: B023
    done = Q.records(spark, base).drop("ts_load").withColumn("open", F.lit(False))
    left = dml.conform(Q.open_entries(spark, base).select("index", F.lit(True).alias("open")), done)
    mark = Q.progress(spark, base).agg(F.max("mark")).scalar()
    return done.unionByName(left).withColumn("mark", mark)


def q_nested_elements(spark, sf):
    """The text of an outer element that holds another of its name, made around each page's heading."""
    rule = Pg.GENERIC_RULES.title
    html = F.concat(F.lit('<section>no</section><section class="a outer">'), F.lit("<section>"), F.coalesce(Pg.field_text(F.col("html"), rule), F.lit("")),
                    F.lit("</section><!-- </section> -->&rarr;&#0000000000065;"), F.col("url"), F.lit("</section>"))
    return _pages(spark, sf).select("page_id", F.get(tx.html_elements(html, "section", "outer"), 0).alias("outer_text"),
                                    F.size(tx.html_elements(html, "section")).alias("n_sections"))


def q_snapshot_wide(spark, sf):
    """Snapshots of 45 columns in two orders, read by header."""
    path, obs = scratch_path(spark, "wide"), _obs(spark, sf)
    more = [f"extra_{i}" for i in range(36)]
    wide = obs.withColumns({m: F.lit(i) for i, m in enumerate(more)})
    year, odd = F.date_format("date", "yyyy"), F.month("date") % 2 == 1
    Sn.write_snapshots(wide.where(odd), f"{path}/a", year, header=[*more, *Sn.SNAPSHOT_HEADER])
    Sn.write_snapshots(wide.where(~odd), f"{path}/b", year, header=[*reversed(Sn.SNAPSHOT_HEADER), *more])
    return Sn.read_snapshots(spark, path, "*.csv", strip=True)


def q_padded_table(spark, sf):
    """A table of blank-padded text columns, read trimmed."""
    path, obs = scratch_path(spark, "padded"), _obs(spark, sf)
    pad = {c: F.concat(F.lit("  "), F.rpad(c, 80, " ")) for c, t in obs.dtypes if t == "string"}
    T.write_table(obs.withColumns(pad), path, "overwrite", skip_empty=False)
    return T.read_table(spark, path)


def q_export_read_back(spark, sf):
    """The fact table exported with a decimal comma and read back from its files."""
    path = scratch_path(spark, "export")
    X.export_csv(_fresh(spark, sf).fact.drop("ts_load"), path)
    back = spark.read.option("header", True).option("sep", ";").csv(path)
    number = lambda c: F.replace(F.col(c), F.lit(","), F.lit(".")).cast("double").alias(c)
    return back.select(*[F.col(c).cast("int") for c in ("id_producto", "id_date")], number("price"), number("unit_price"), number("discount"), F.col("year").cast("int"))


def q_records_csv(spark, sf):
    """Captured shop records, whose lists of categories hold separators, written as ``,`` CSV with a header and read back by name."""
    path, record = scratch_path(spark, "records-csv"), {f.name: f.dataType for f in schemas.PRODUCT_RECORD.fields if f.name != "ts_load"}
    ok, _ = capture_products(_shop_pages(spark, sf), Pg.SHOP_RULES, run_date=RUN_DATE, load_ts=LOAD_TS)
    X.export_csv(ok.drop("ts_load"), path, sep=",", decimal=".")
    back = spark.read.option("header", True).csv(path)
    return back.select(F.col("page_id").cast("bigint"), *[F.col(c).cast(t).alias(c) for c, t in record.items()])


def q_backup_and_clear(spark, sf):
    """A fact table copied under a dated name, cleared and filled again from the copy; its load time stays."""
    path = scratch_path(spark, "fact")
    T.write_table(_fresh(spark, sf).fact, path, "overwrite", skip_empty=False)
    copy = T.backup_table(spark, path, path, LOAD_TS.date())
    T.replace_table(dml.delete_all(T.raw_table(spark, path)), path)
    T.write_table(T.raw_table(spark, copy), path, "append")
    loaded = F.date_format("ts_load", "yyyy-MM-dd HH:mm:ss").alias("loaded")
    return T.raw_table(spark, path).groupBy("year", loaded).agg(F.count(F.lit(1)).alias("n"))


def q_sitemap_files(spark, sf):
    """The work queue of stored sitemap documents, every third entry of which is no product."""
    k, path = F.col("p_partkey"), scratch_path(spark, "sitemap")
    url = F.concat(F.lit("https://shop.example/"), F.when(k % 3 == 0, F.lit("help/")).otherwise(F.lit("all/p/")), k.cast("string"))
    lines = O.read_table(spark, sf, "part").orderBy(k).select(F.concat(F.lit("<url><loc> "), url, F.lit(" </loc></url>")))
    lines.write.text(path)
    return queue_from_sitemap_files(spark, path)


def q_id_chunks(spark, sf):
    """Products seen in a year, in cells of at most 500 ids."""
    return Qy.id_chunks(_obs(spark, sf).withColumn("year", F.year("date")), "year", "product_id", 500)


def q_outside_whiskers(spark, sf):
    return St.outside_whiskers(_obs(spark, sf), "price", 0.25)  # none lies beyond 0.5


def q_ingest_latest(spark, sf):
    """Shop pages captured twice, half of them with other prices at first: of a page the later file counts."""
    pages = _shop_pages(spark, sf)
    src, rec, rej = (scratch_path(spark, n) for n in ("pages-in", "records", "rejects"))
    pages.withColumn("html", F.when(F.col("page_id") % 2 == 0, F.regexp_replace("html", "[0-9]+,[0-9]+", "1,11")).otherwise(F.col("html"))).write.parquet(f"{src}/z")
    time.sleep(1.1)  # file times may be whole seconds
    pages.write.parquet(f"{src}/a")
    ingest_pages(spark, f"{src}/*", rec, rej, scratch_path(spark, "ck"), RUN_DATE, Pg.SHOP_RULES, 16, LOAD_TS)
    return _ingested(spark, rec, rej)


def _month(c: str = "date"):
    return F.date_format(c, "yyyy-MM").alias("month")


def q_quantiles_from_sketches(spark, sf):
    """Monthly price quantiles from daily sketches: how many of five are within the rank error of the exact ranks (all)."""
    obs, probs = _obs(spark, sf), [0.05, 0.25, 0.5, 0.75, 0.95]
    monthly = Su.merge_quantile_sketches(Su.quantile_sketches(obs, "date", "price"), _month())
    found = Su.sketched_quantiles(monthly, probs)
    each = found.select("month", "n", "low", "high", F.posexplode("quantiles").alias("i", "q"))
    prices = obs.select(_month(), "price").withColumnRenamed("month", "_m")
    ranks = each.join(prices, F.col("month") == F.col("_m")).groupBy("month", "n", "low", "high", "i").agg(
        F.count_if(F.col("price") < F.col("q")).alias("below"), F.count_if(F.col("price") <= F.col("q")).alias("upto"))
    p = F.element_at(F.array(*map(F.lit, probs)), F.col("i") + 1)
    slack = Su.RANK_ERROR * F.col("n") + 1
    right = (F.col("below") - slack <= p * F.col("n")) & (p * F.col("n") <= F.col("upto") + slack)
    return ranks.groupBy("month", "n", "low", "high").agg(F.count_if(right).alias("within"))


def q_distinct_from_sketches(spark, sf):
    """Distinct products per month from daily sketches: whether they are within 4 % of the exact count."""
    obs = _obs(spark, sf)
    about = Su.sketched_distinct(Su.merge_distinct_sketches(Su.distinct_sketches(obs, "date", "product_id"), _month()))
    exact = obs.groupBy(_month()).agg(F.countDistinct("product_id").alias("n_products"))
    near = F.abs(F.col("n_distinct") - F.col("n_products")) <= 0.04 * F.col("n_products")
    return about.join(exact, "month").select("month", "n_products", near.alias("near"))


def q_normality_from_moments(spark, sf):
    """The normality test of the outlier-free unit prices, from moments that were kept per day."""
    return Su.normality_of_moments(Su.merge_moments(Su.moments(_trimmed(spark, sf), "date", "unit_price"), F.lit(1).alias("all")), digits=DIGITS)


def q_density_binned(spark, sf):
    """The binned density of prices against the direct sum: grid points, and whether the error is below 1e-6 of the top."""
    binned = St.density_binned(_obs(spark, sf), "price", 1000)
    exact = St.density(_obs(spark, sf), "price", 1000).select("i", F.col("density").alias("direct"))
    both = binned.join(exact, "i")
    top = exact.agg(F.max("direct")).scalar()
    return both.select("i", F.round("x", DIGITS).alias("x"), (F.abs(F.col("density") - F.col("direct")) <= 1e-6 * top).alias("near"))


QUERIES = {
    "product_dim_buckets": q_product_dim_buckets,
    "load_after_losses": q_load_after_losses,
    "variation_by_batches": q_variation_by_batches,
    "queue_capture": q_queue_capture,
    "nested_elements": q_nested_elements,
    "snapshot_wide": q_snapshot_wide,
    "padded_table": q_padded_table,
    "export_read_back": q_export_read_back,
    "records_csv": q_records_csv,
    "backup_and_clear": q_backup_and_clear,
    "sitemap_files": q_sitemap_files,
    "id_chunks": q_id_chunks,
    "outside_whiskers": q_outside_whiskers,
    "ingest_latest": q_ingest_latest,
    "quantiles_from_sketches": q_quantiles_from_sketches,
    "distinct_from_sketches": q_distinct_from_sketches,
    "normality_from_moments": q_normality_from_moments,
    "density_binned": q_density_binned,
}

_WAREHOUSE = BASE_ORACLE["warehouse_reload_idempotent"].rsplit("\nSELECT", 1)[0]

ORACLE = {
    "product_dim_buckets": BASE_ORACLE["product_dim_insert"],
    "load_after_losses": "WITH " + OBS_SQL + "\nSELECT product_id, date, price, unit_price, discount, CAST(year(date) AS INTEGER) AS year FROM obs",
    "variation_by_batches": "WITH " + VARIATION_SQL + "\nSELECT * FROM variacion",
    "queue_capture": "WITH " + SHOP_SQL + f""",
queue AS (SELECT *, page_id - 1 AS "index", page_id % 11 = 5 AS open FROM shop WHERE (page_id - 1) % 7 <> 3)
SELECT "index", {", ".join(f"CASE WHEN NOT open THEN {c.strip()} END AS {c.strip()}" for c in SHOP_COLS.split(","))}, open,
       coalesce((SELECT min("index") FILTER (open) - 1 FROM queue), (SELECT max("index") FROM queue)) AS mark FROM queue""",
    "nested_elements": f"""SELECT page_id, coalesce({_sql_first("html", Pg.GENERIC_RULES.title)}, '') || '→A' || url AS outer_text,
       CAST(3 AS INTEGER) AS n_sections FROM pages""",
    "snapshot_wide": BASE_ORACLE["csv_snapshot_roundtrip"],
    "padded_table": "WITH " + OBS_SQL + f"\nSELECT {OBS_COLS} FROM obs",
    "export_read_back": _WAREHOUSE + "\nSELECT id_producto, id_date, price, unit_price, discount, year FROM fact",
    "records_csv": "WITH " + SHOP_SQL + f"\nSELECT page_id, {SHOP_COLS.replace(', reject_reason', '')} FROM shop WHERE reject_reason IS NULL",
    "backup_and_clear": _WAREHOUSE + f"\nSELECT year, '{LOAD_TS:%Y-%m-%d %H:%M:%S}' AS loaded, count(*) AS n FROM fact GROUP BY year",
    "sitemap_files": BASE_ORACLE["sitemap_queue"],
    "id_chunks": "WITH " + OBS_SQL + """,
d AS (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year, product_id FROM obs WHERE product_id IS NOT NULL),
r AS (SELECT *, (row_number() OVER (ORDER BY year, product_id) - 1) // 500 AS cell FROM d),
c AS (SELECT year, cell, string_agg(product_id, ',' ORDER BY product_id) AS ids FROM r GROUP BY year, cell)
SELECT year, CAST(cell - min(cell) OVER (PARTITION BY year) AS BIGINT) AS part, ids FROM c""",
    "outside_whiskers": "WITH " + OBS_SQL + ",\n" + FENCES_SQL.replace("unit_price", "price").replace("1.5", "0.25") + f"""
SELECT {OBS_COLS}, CASE WHEN price < lower_fence THEN 'below' ELSE 'above' END AS side FROM obs, f2 WHERE price < lower_fence OR price > upper_fence""",
    "ingest_latest": BASE_ORACLE["shop_page_records"],
    "quantiles_from_sketches": "WITH " + OBS_SQL + """
SELECT strftime(date, '%Y-%m') AS month, count(*) AS n, min(price) AS low, max(price) AS high, CAST(5 AS BIGINT) AS within FROM obs GROUP BY 1""",
    "distinct_from_sketches": "WITH " + OBS_SQL + """
SELECT strftime(date, '%Y-%m') AS month, count(DISTINCT product_id) AS n_products, true AS near FROM obs GROUP BY 1""",
    "normality_from_moments": BASE_ORACLE["normality_price"],
    "density_binned": BASE_ORACLE["density_price"].split("SELECT g.i,")[0] + "SELECT i, round(x, 6) AS x, true AS near FROM g",
}
