"""Shards of near-equal bytes by a k-d tree over document metadata (operator 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import before_sums
from shelfwatch.operators.keys import with_global_rank
from shelfwatch.session import stage_table

SCALE = 1 << 30  # a dimension is scaled to so many steps; 32 hash bits below them separate equal values
BINS = 2048
TOLERANCE = 1 / 8192  # of a node's bytes: a median found this closely is not searched further


def text_codes(df: DataFrame, c: str) -> DataFrame:
    """``df`` with ``d_<c>``: the place of the text column's value among its different values; null comes first, as -1."""
    values = with_global_rank(df.select(c).where(F.col(c).isNotNull()).distinct(), [c], "_rank")
    return (df.join(values.withColumnRenamed(c, "_value"), F.col(c) == F.col("_value"), "left")
            .withColumn(f"d_{c}", F.coalesce(F.col("_rank").cast("double"), F.lit(-1.0))).drop("_value", "_rank"))


#: a dimension is a text column, ordered by its values, or an expression
DIMENSIONS = {
    "source": "source",
    "lang": "lang",
    "size": lambda: F.log2(F.col("size").cast("double")),
}


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, keep: list[str] | None = None,
              dimensions: dict | None = None, slot_bits: int = 9) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs(doc_id, text, source, lang)``,
    and the columns named in ``keep`` as ``keep_<name>``.

    The corpus is one node with as many leaves as asked for (``shards``, or the
    total over ``target_bytes``). Level by level each node is cut along the
    dimension on which it is widest, relative to the corpus, at the weighted
    quantile that gives both sides bytes in proportion to their leaves, until
    every node is one leaf. Equal values on a dimension are told apart by a
    hash of the row, so a value with a third of the rows can be cut; only rows
    equal in doc_id and text stay together. A quantile is found by histograms
    that zoom into the bin it lies in; per level only one row per node reaches
    the driver, and nodes are bounded by the number of shards.

    Size is the UTF-8 bytes of the text plus 1 (null text: 1). Null metadata
    come first on their dimension. Slots run from 0 in each shard without gaps.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    dims = dimensions or DIMENSIONS
    keep = keep or []
    base = docs.select(
        "doc_id", *[F.col(c).alias(f"keep_{c}") for c in keep], "source", "lang",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    base = base.withColumn("h", F.xxhash64("doc_id", "text_crc32", "size"))
    for n, f in dims.items():
        base = text_codes(base, f) if isinstance(f, str) else base.withColumn(f"d_{n}", f())
    base = stage_table(base.drop("source", "lang"), "kd")
    edges = base.agg(F.sum("size").alias("total"), *[g(f"d_{n}").alias(f"{g.__name__}_{n}") for n in dims for g in (F.min, F.max)]).first()
    if edges["total"] is None:
        return base.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"),
                           *[f"keep_{c}" for c in keep])
    if shards is None:
        shards = max(1, -(-edges["total"] // target_bytes))
    low32 = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))
    keys = {}
    for n in dims:
        lo, hi = edges[f"min_{n}"], edges[f"max_{n}"]
        step = F.floor((F.col(f"d_{n}") - lo) * ((SCALE - 1) / (hi - lo)) if hi > lo else F.lit(0.0)).cast("long")
        keys[n] = F.shiftleft(step, 32) + low32
    cur = base.select("*", *[k.alias(f"k_{n}") for n, k in keys.items()]).withColumn("node", F.lit(0))
    leaves = {0: shards}  # first shard of a node: number of its leaves
    while any(k > 1 for k in leaves.values()):
        open_nodes = {n: k for n, k in leaves.items() if k > 1}
        cut = _cuts(cur, open_nodes, list(dims))
        plan = [(n, *cut.get(n, (0, 0)), n + k // 2) for n, k in open_nodes.items()]
        table = spark.createDataFrame(plan, "_node int, _dim int, _cut long, _right int")
        # one row per open node, fewer than shards
        cur = (cur.join(F.broadcast(table), F.col("node") == F.col("_node"), "left")
               .withColumn("node", F.when(_key(list(dims)) >= F.col("_cut"), F.col("_right")).otherwise(F.col("node")))
               .drop("_node", "_dim", "_cut", "_right"))
        leaves = {m: x for n, k in leaves.items() for m, x in ([(n, k // 2), (n + k // 2, k - k // 2)] if k > 1 else [(n, 1)])}
    placed = cur.withColumn("bucket", F.shiftright("h", 64 - slot_bits).cast("int"))
    placed = before_sums(placed, "node", "bucket", [F.col("h"), F.col("doc_id"), F.col("text_crc32")], F.lit(1).cast("long"), "slot")
    return placed.select("doc_id", "size", "text_crc32", F.col("node").alias("shard"), "slot",
                         *[f"keep_{c}" for c in keep])


def _key(dims: list[str]) -> Column:
    out = F.lit(None).cast("long")
    for i, n in enumerate(dims):
        out = F.when(F.col("_dim") == i, F.col(f"k_{n}")).otherwise(out)
    return out


def _cuts(cur: DataFrame, quota: dict[int, int], dims: list[str]) -> dict[int, tuple[int, int]]:
    """For every open node the dimension and the key from which rows go to the right."""
    spark = cur.sparkSession
    stats = cur.where(F.col("node").isin(list(quota)) if len(quota) <= 1000 else F.lit(True)).groupBy("node").agg(
        F.sum("size").alias("w"), *[g(f"k_{n}").alias(f"{g.__name__}_{n}") for n in dims for g in (F.min, F.max)]).collect()
    search: dict[int, list] = {}
    for r in stats:
        if r["node"] in quota:
            wide = max(range(len(dims)), key=lambda i: ((r[f"max_{dims[i]}"] >> 32) - (r[f"min_{dims[i]}"] >> 32), -i))
            k = quota[r["node"]]
            # dimension, low key, high key, bytes below low, bytes wanted below the cut, tolerance
            search[r["node"]] = [wide, r[f"min_{dims[wide]}"], r[f"max_{dims[wide]}"], 0, r["w"] * (k // 2) / k, r["w"] * TOLERANCE]
    done: dict[int, tuple[int, int]] = {}
    while search:
        table = spark.createDataFrame(
            [(n, s[0], s[1], s[2], (s[2] - s[1]) // BINS + 1, float(s[4] - s[3])) for n, s in search.items()],
            "_node int, _dim int, _lo long, _hi long, _step long, _need double")
        inside = cur.join(F.broadcast(table), F.col("node") == F.col("_node")).withColumn("_k", _key(dims))
        bins = (inside.where("_k BETWEEN _lo AND _hi")
                .groupBy("_node", "_need", F.expr("(_k - _lo) div _step").alias("bin")).agg(F.sum("size").alias("w")))
        upto = F.sum("w").over(Window.partitionBy("_node").orderBy("bin"))
        hits = bins.withColumn("upto", upto).where("upto > _need AND upto - w <= _need").collect()
        found = {r["_node"]: r for r in hits}
        for n, s in list(search.items()):
            wide, lo, hi, below, want, near = s
            step = (hi - lo) // BINS + 1
            r = found.get(n)
            if r is None:  # nothing left to cut: all bytes lie below
                done[n] = (wide, hi + 1)
                del search[n]
                continue
            first, last = lo + r["bin"] * step, lo + (r["bin"] + 1) * step - 1
            below += r["upto"] - r["w"]
            if step == 1 or r["w"] <= near:
                done[n] = (wide, first if want - below < r["w"] / 2 else last + 1)
                del search[n]
            else:
                s[1], s[2], s[3] = first, last, below
    return done
