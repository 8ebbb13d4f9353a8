"""Table catalogue: explicit schemas, nothing inferred. All columns nullable."""

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, I, L, DT, TS = StringType(), DoubleType(), IntegerType(), LongType(), DateType(), TimestampType()

# Daily snapshot file, by header name (the file column order varies).
SNAPSHOT = _s(("product_id", S), ("price", D), ("product", S), ("brand", S), ("unit_price", D),
              ("units", S), ("categories", S), ("discount", D), ("date", DT))
# Snapshot with a load time, as the loader declares it.
SNAPSHOT_LOADED = _s(("date", DT), ("product", S), ("product_id", S), ("brand", S), ("price", D),
                     ("categories", S), ("unit_price", D), ("units", S), ("discount", D),
                     ("ts_load", TS))
# One captured product record.
PRODUCT_RECORD = _s(("product", S), ("product_id", S), ("brand", S), ("price", D), ("categories", S),
                    ("unit_price", D), ("units", S), ("discount", D), ("date", DT), ("ts_load", TS))
# Work queue of product pages.
STAGING_PRODUCT = _s(("id_producto", S), ("url_product", S), ("index", I))

SEQUENCES = _s(("table_name", S), ("id", L), ("ts_load", TS))
DATE_DIM = _s(("id_date", I), ("date", DT), ("year", I), ("ts_load", TS))
PRODUCT_DIM = _s(("id_producto", I), ("product", S), ("brand", S), ("categories", S), ("product_id", S),
                 ("date", DT), ("categoria", S), ("units", S), ("ts_load", TS))
PRICE_FACT = _s(("id_producto", I), ("id_date", I), ("price", D), ("unit_price", D), ("discount", D),
                ("year", I), ("ts_load", TS))
PRICE_INDEX = _s(("id_date", I), ("sum_price", D), ("sum_unit_price", D), ("num_products", L),
                 ("sum_price_ponderado", D), ("sum_unit_price_ponderado", D), ("sum_price_norm", D),
                 ("sum_unit_price_norm", D), ("ts_load", TS))

WAREHOUSE = {
    "sequences_cfg": SEQUENCES,
    "date_dim": DATE_DIM,
    "producto_dim": PRODUCT_DIM,
    "producto_dia_fact": PRICE_FACT,
    "precio_dia_agg_norm_fact": PRICE_INDEX,
}
CAPTURE = {"producto_dim": PRODUCT_RECORD, "staging_product": STAGING_PRODUCT}
# Partition columns per table.
PARTITIONING = {"producto_dia_fact": ["year"]}
