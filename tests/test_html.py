"""Elements by the depth of their tags, and entities, against plain code."""

import html as html_lib
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfwatch.functions import text as tx


def plain_inner(doc, tag, css_class=None):
    """Inner HTML of matching elements, by walking over the tags of the name."""
    doc = re.sub(r"(?s)<!--.*?-->", "", doc)
    doc = re.sub(r"(?is)(<(script|style)\b[^>]*>).*?(?=</\2\s*>)", r"\1", doc)
    tags = list(re.finditer(rf"(?is)<{tag}(?:\s[^>]*)?>|</{tag}\s*>", doc))
    out = []
    for i, m in enumerate(tags):
        if m.group().startswith("</"):
            continue
        if css_class:
            attr = re.search(r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)')""", m.group())
            if not attr or css_class not in (attr.group(1) or attr.group(2) or "").split():
                continue
        depth = 1
        for e in tags[i + 1:]:
            depth += -1 if e.group().startswith("</") else 1
            if depth == 0:
                out.append(doc[m.end():e.start()])
                break
    return out


CASES = [
    '<div class="x">a<div>b</div>c</div>d', '<div class="x">a<div class="x">b</div>c</div>', "<DIV Class='y x z'>1</DIV ><div>2</div>",
    '<div class="x">open<div>in</div>', '</div><div class="x">after a stray end</div>', '<div class="x">1</div></div><div class="x"><div>2</div></div>',
    '<div class="x"><!-- <div> --><br><img src="a>b">v</div>', '<div class="x"><script>var a = "<div>";</script><div>k</div></div>', "", "no tags",
    '<divider class="x">n</divider><div class="x">y</div>', '<div class="xy">n</div>', '<div\nclass="x"><div></div></div>',
]


@pytest.mark.parametrize("css_class", [None, "x"])
def test_nested_elements(spark, css_class):
    rng = random.Random(8)
    pieces = ['<div class="x">', "<div>", "</div>", "<p>", "</p>", "t", "<!-- c -->", "<br>"]
    docs = CASES + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(150)] + ['<div class="x">' * 300 + "deep" + "</div>" * 300]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, h string").repartition(4)
    got = {r.i: r.e for r in df.select("i", tx.html_inner("h", "div", css_class).alias("e")).collect()}
    assert got == {i: plain_inner(d, "div", css_class) for i, d in enumerate(docs)}


def test_null_html_has_no_elements(spark):
    assert spark.createDataFrame([(None,)], "h string").select(tx.html_elements("h", "p").alias("e")).first().e is None


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [[], [5]] + [[rng.randint(-3, 3) for _ in range(n)] for n in (63, 64, 65, 128, 1000)]
    got = spark.createDataFrame([(r,) for r in rows], "v array<int>").select(tx.running_sums(F.col("v")).alias("s")).collect()
    assert [r.s for r in got] == [[sum(v[:i + 1]) for i in range(len(v))] for v in rows]


def test_all_named_entities_and_long_numbers(spark):
    texts = ["&copy; &rarr; &NotEqualTilde; &amp;copy; &nosuch; & &; &lt;", "&#00000000065;&#x000000041;&#1114112;&#99999999999;&#xD800;&#0;", "&eacute;t&eacute; &#39;a&#x27;"]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.decode_entities("t").alias("t")).collect()]
    assert got[0] == html_lib.unescape("&copy; &rarr; &NotEqualTilde;") + " &copy; &nosuch; & &; <"
    assert got[1] == "AA&#1114112;&#99999999999;&#xD800;&#0;"
    assert got[2] == "été 'a'"


def test_the_entity_table_is_a_constant_of_the_plan(spark):
    plan = spark.range(1).select(tx.decode_entities(F.concat(F.lit("&copy;"), F.col("id").cast("string"))).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "str_to_map" not in plan
