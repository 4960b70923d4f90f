from decimal import Decimal

from pyspark.sql import functions as F

from cartwheel.functions.columns import PRICE_BANDS, price_band, rate
from cartwheel.operators import cleaning as cl


def test_price_band_edges(spark):
    prices = [None, "0", "0.01", "50", "100", "250", "500", "1000", "2000", "2000.01", "-1"]
    expected = ["Unknown", "$0", "$0–$50", "$0–$50", "$50–$100", "$100–$250", "$250–$500",
                "$500–$1,000", "$1,000–$2,000", "$2,000+", "$0–$50"]
    df = spark.createDataFrame([(i, None if p is None else Decimal(p)) for i, p in enumerate(prices)],
                               "i int, price decimal(14,2)")
    got = [r.b for r in df.select("i", price_band("price").alias("b")).orderBy("i").collect()]
    assert got == expected
    assert "–".encode() == b"\xe2\x80\x93" and all(b in PRICE_BANDS for b in got)


def test_rates_null_on_zero(spark):
    df = spark.createDataFrame([(0, 0, 0), (10, 0, 0), (10, 4, 2)], "v long, c long, p long")
    got = [(r.vc, r.cp) for r in df.select(rate("c", "v").alias("vc"), rate("p", "c").alias("cp")).collect()]
    assert got == [(None, None), (0.0, None), (0.4, 0.5)]


def test_null_tokens_and_fill(spark):
    df = spark.createDataFrame([(t,) for t in ["", "NA", "null", "None", "acme", None]], "brand string")
    got = [r.brand for r in cl.fill_unknown(cl.normalize_null_tokens(df, ["brand"])).collect()]
    assert got == ["Unknown"] * 4 + ["acme", "Unknown"]


def test_standardize_strict_and_lenient(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:04 UTC", "view", "3", "4", "1.5", "7"),
                                ("garbage", "cart", "x", "4", "n/a", "8")],
                               "event_time string, event_type string, product_id string, category_id string, "
                               "price string, user_id string")
    lenient = cl.coerce_lenient(df).collect()
    assert lenient[1].event_time is None and lenient[1].product_id is None and lenient[1].price is None
    assert lenient[0].event_time.second == 4 and lenient[0].price == 1.5
    ok = cl.standardize(df.where("product_id = '3'")).collect()[0]
    assert ok.product_id == 3 and ok.user_id == 7


def test_time_features(spark):
    df = spark.createDataFrame([("2019-10-01 09:30:00 UTC",)], "event_time string")
    r = cl.add_time_features(cl.standardize(df)).collect()[0]
    assert (r.event_hour, r.day_of_week, r.day_of_month, str(r.event_date)) == (9, "Tuesday", 1, "2019-10-01")
    assert df.select(F.lit(1)).count() == 1


def test_scale_conf_partitions():
    from cartwheel.session import scale_conf
    big = scale_conf(100 * 2 ** 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(big["spark.sql.shuffle.partitions"]) * 256 * 2 ** 20 >= 100 * 2 ** 40
    assert scale_conf(10 * 2 ** 20, 8)["spark.sql.shuffle.partitions"] == "16"


def test_clean_events_reads_tokens_as_missing(spark):
    rows = [("2019-10-01 00:00:01 UTC", "view", "1", "2", "NA", "NA", "", "7", "s", 1),
            ("2019-10-01 00:00:02 UTC", "purchase", "1", "2", "c", "b", "5.5", "7", "null", 2)]
    df = spark.createDataFrame(rows, "event_time string, event_type string, product_id string, category_id string, "
                                     "category_code string, brand string, price string, user_id string, "
                                     "user_session string, seq long")
    got = {r.seq: (r.category_code, r.brand, r.price, r.user_session) for r in cl.clean_events(df).collect()}
    assert got == {1: ("Unknown", "Unknown", None, "s"), 2: ("c", "b", 5.5, "Unknown")}
