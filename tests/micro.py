"""Hand-made micro fixtures (times are minutes after 2019-10-01 00:00)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

T0 = dt.datetime(2019, 10, 1)

SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DecimalType(14, 2)),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])


def ev(seq, user, typ, minute, price=None, cat="A", brand="b"):
    return (seq, T0 + dt.timedelta(minutes=minute), typ, 1, 1, cat, brand,
            None if price is None else Decimal(str(price)), user, f"s{user}")


def funnel_rows():
    s = iter(range(1, 10_000))
    rows = [
        ev(next(s), 1, "view", 1), ev(next(s), 1, "cart", 2), ev(next(s), 1, "purchase", 3, 10),
        ev(next(s), 2, "cart", 1), ev(next(s), 2, "view", 2), ev(next(s), 2, "purchase", 3, 10),
        ev(next(s), 3, "cart", 1), ev(next(s), 3, "view", 2), ev(next(s), 3, "cart", 3),
        ev(next(s), 3, "purchase", 4, 5), ev(next(s), 3, "purchase", 5, 6),
        ev(next(s), 4, "view", 1), ev(next(s), 4, "purchase", 2, 7), ev(next(s), 4, "cart", 3),
        ev(next(s), 5, "purchase", 1, 9),
        ev(next(s), 6, "view", 1), ev(next(s), 6, "cart", 2), ev(next(s), 6, "remove_from_cart", 3),
        ev(next(s), 6, "purchase", 4, 8),
        ev(next(s), 7, "remove_from_cart", 1),
        ev(100, 8, "view", 1), ev(101, 8, "cart", 1), ev(102, 8, "purchase", 1, 3),
        ev(200, 9, "purchase", 1, 3), ev(201, 9, "cart", 1), ev(202, 9, "view", 1),
        ev(300, 10, "view", 1, cat="A"), ev(301, 10, "cart", 2, cat="B"),
        ev(302, 10, "purchase", 3, 4, cat="B"),
    ]
    return rows


# user: (viewed, added_to_cart, purchased, first_view, first_cart, first_purchase, count, revenue)
EXPECTED_USER = {
    1: (1, 1, 1, 1, 2, 3, 1, 10.0),
    2: (1, 0, 0, 2, None, None, 1, 10.0),
    3: (1, 1, 1, 2, 3, 4, 2, 11.0),
    4: (1, 1, 0, 1, 3, None, 1, 7.0),
    5: (0, 0, 0, None, None, None, 1, 9.0),
    6: (1, 1, 1, 1, 2, 4, 1, 8.0),
    7: (0, 0, 0, None, None, None, 0, 0.0),
    8: (1, 1, 1, 1, 1, 1, 1, 3.0),
    9: (1, 0, 0, 1, None, None, 1, 3.0),
    10: (1, 1, 1, 1, 2, 3, 1, 4.0),
}
