"""Documents and id lists larger than a task or a cell, rows beyond the whiskers."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import quality as Qy, stats as St
from shelfwatch.plans import capture
from shelfwatch.sources import pages as Pg


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("3999b", "0b")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def test_sitemap_of_one_line_is_split_over_tasks(spark, tmp_path, small_blocks):
    rng = random.Random(2)
    urls = [f"https://shop.example/all/{'x' * rng.randrange(60)}/{'p' if i % 3 else 'help'}/{i}" for i in range(1500)]
    xml = '<?xml version="1.0"?>\n<urlset>' + "".join(f"<url><loc>{' ' * rng.randrange(3)}{u}\n</loc></url>" for u in urls) + "</urlset>"
    (tmp_path / "maps").mkdir()
    (tmp_path / "maps" / "b.xml").write_text(xml)
    (tmp_path / "maps" / "a.xml").write_text("<urlset><url><loc>https://shop.example/all/p/7</loc></url><url><loc>https://shop.example/all/p/8")  # cut off
    (tmp_path / "maps" / "c.xml").write_text("")
    found = Pg.sitemap_file_urls(spark, str(tmp_path / "maps"))
    assert found.rdd.getNumPartitions() > 20
    assert found.select("doc", "block").distinct().count() > 20
    whole = spark.createDataFrame([(0, (tmp_path / "maps" / "a.xml").read_text()), (1, xml)], "doc long, xml string")
    want = {r["index"]: tuple(r) for r in capture.queue_from_sitemap(whole, "xml", "doc").collect()}
    got = {r["index"]: tuple(r) for r in capture.queue_from_sitemap_files(spark, str(tmp_path / "maps")).collect()}
    assert got == want and len(got) == 1001


def test_sitemap_folder_without_entries(spark, tmp_path):
    (tmp_path / "a.xml").write_text("")
    assert capture.queue_from_sitemap_files(spark, str(tmp_path)).count() == 0


def test_id_chunks_join_to_the_whole_list(spark):
    rng = random.Random(4)
    rows = [("hot", i) for i in range(1000)] + [(f"g{rng.randrange(30)}", rng.randrange(400)) for _ in range(2000)] + [(None, 5), (None, 6), ("g1", None)]
    df = spark.createDataFrame(rows * 2, "g string, id long").repartition(5)
    cells = Qy.id_chunks(df, "g", "id", 37)
    got = cells.collect()
    assert max(len(r.ids.split(",")) for r in got) == 37
    parts = {}
    for r in got:
        parts.setdefault(r.g, []).append(r.part)
    assert all(sorted(p) == list(range(len(p))) for p in parts.values())
    assert len(parts["hot"]) >= 1000 // 37
    want = {r.g: r.ids for r in Qy.ids_concat(df, "g", "id").collect()}
    assert {r.g: r.ids for r in Qy.join_chunks(cells, "g").collect()} == want
    assert Qy.id_chunks(df.limit(0), "g", "id").count() == 0


def test_rows_outside_the_whiskers(spark):
    values = [-50.0, *[float(i) for i in range(1, 12)], 40.0, 41.0, None]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, k int")
    assert [(r.v, r.side) for r in St.outside_whiskers(df, "v").collect()] == [(-50.0, "below"), (40.0, "above"), (41.0, "above")]
    box = St.boxplot_whiskers(df, "v").first()
    assert (box.n_below, box.n_above) == (1, 2)
    assert St.outside_whiskers(df.where(F.lit(False)), "v").count() == 0
