"""Adapter from the generic test tables to the clickstream event schema.

The test data has an ``events`` table (event_id, ts, user_id, event_type,
value, props json) and a TPC-H style ``part`` table.  This maps them to the
nine raw clickstream columns plus ``seq`` (ingestion order), following the
fixed rules below.  The product → part lookup is an ordinary equi-join;
Catalyst broadcasts ``part`` only while its estimated size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed adapter rules (must match the oracle SQL).
# ---------------------------------------------------------------------------
TYPE_MAP = {"click": "cart", "error": "remove_from_cart"}
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
MISSING_CATEGORY = "PROMO"
MISSING_BRAND = "Brand#13"
ZERO_PRICE_EVERY = 97
MISSING_PRICE_EVERY = 211
NEGATIVE_PRICE_EVERY = 503
MISSING_SESSION_EVERY = 401
DUP2_EVERY = 50
DUP3_EVERY = 250
COPY_SEQ_OFFSET = 10 ** 9
VIEWLESS_USER_EVERY = 3
CHUNK_ROWS = 1000
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PART_COLUMNS = ("category_id", "category_code", "brand")


def shop_events(spark: SparkSession, sf_dir: str, variant: str = "base", columns: list[str] | None = None) -> DataFrame:
    """Raw clickstream events derived from ``events`` ⋈ ``part``.

    columns: what the caller will read; without a column of ``part`` the
    join (on its primary key, so it changes no rows) is left out, and unread
    columns, parsed JSON included, are pruned at the scan.

    variant: ``base`` | ``missing_price`` | ``dirty`` | ``duplicates`` |
    ``disordered`` | ``thinned`` (every VIEWLESS_USER_EVERY-th user has no views)
    """
    ev = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    et = F.col("event_type")
    mapped = F.when(et == "click", "cart").when(et == "error", "remove_from_cart").otherwise(et)
    eid = F.col("event_id")
    price = (F.when(eid % ZERO_PRICE_EVERY == 0, F.lit(0).cast("decimal(14,2)"))
             .otherwise((F.col("value").cast("decimal(12,2)") * 10).cast("decimal(14,2)")))
    if variant == "missing_price":
        price = F.when(eid % MISSING_PRICE_EVERY == 0, F.lit(None).cast("decimal(14,2)")).otherwise(price)
    if variant == "dirty":
        price = F.when(eid % NEGATIVE_PRICE_EVERY == 0, -price).otherwise(price)
    cat_pos = F.array_position(F.array(*[F.lit(t) for t in PART_TYPES]), F.col("p_type"))
    session = (F.when(eid % MISSING_SESSION_EVERY == 0, F.lit(None).cast("string"))
               .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("-"),
                                   F.date_format("ts", "yyyy-MM-dd"))))
    with_part = columns is None or any(c in PART_COLUMNS for c in columns)
    from_part = [
        F.when(cat_pos > 0, cat_pos.cast("bigint")).alias("category_id"),
        F.nullif(F.col("p_type"), F.lit(MISSING_CATEGORY)).alias("category_code"),
        F.nullif(F.col("p_brand"), F.lit(MISSING_BRAND)).alias("brand")]
    if variant == "thinned":
        ev = ev.where(~((et == "view") & (F.col("user_id") % VIEWLESS_USER_EVERY == 0)))
    base = ev.withColumn("k", k)
    if with_part:
        base = base.join(part, F.col("k") == F.col("p_partkey"), "left")
    base = base.select(
        eid.alias("seq"),
        F.col("ts").alias("event_time"),
        mapped.alias("event_type"),
        F.col("k").alias("product_id"),
        *(from_part if with_part else []),
        price.alias("price"),
        F.col("user_id"),
        session.alias("user_session"))
    if columns is not None:
        base = base.select("seq", *[c for c in columns if c != "seq"])
    if variant == "duplicates":
        c2 = base.where(F.col("seq") % DUP2_EVERY == 0).withColumn("seq", F.col("seq") + COPY_SEQ_OFFSET)
        c3 = base.where(F.col("seq") % DUP3_EVERY == 0).withColumn("seq", F.col("seq") + 2 * COPY_SEQ_OFFSET)
        return base.unionByName(c2).unionByName(c3)
    if variant == "disordered":
        # chunks 1 and 2 swap places in ingestion order
        chunk = F.floor(F.col("seq") / CHUNK_ROWS)
        shift = (F.when(chunk == 1, F.lit(CHUNK_ROWS)).when(chunk == 2, F.lit(-CHUNK_ROWS))
                 .otherwise(F.lit(0)))
        return base.withColumn("seq", F.col("seq") + shift)
    return base


def chunk_of(seq="seq", rows: int = CHUNK_ROWS):
    return F.floor(F.col(seq) / rows).cast("bigint")
