"""Brute force: random per-user event sequences (with timestamp ties and
file order different from time order) against a sequential state machine
written in plain Python."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from cartwheel.operators import funnel as fn
from tests.micro import SCHEMA, T0

TYPES = ["view", "cart", "purchase", "remove_from_cart", "signup"]


def _random_events(n_users=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    seqs = list(range(1, n_users * 12 + 1))
    rnd.shuffle(seqs)
    it = iter(seqs)
    for u in range(1, n_users + 1):
        for _ in range(rnd.randint(1, 12)):
            minute = rnd.randint(0, 5)                       # few distinct times → many ties
            price = Decimal(rnd.randint(0, 500)) / 4
            rows.append((next(it), T0 + dt.timedelta(minutes=minute), rnd.choice(TYPES), 1, 1,
                         rnd.choice(["A", "B"]), "b", price, u, "s"))
    return rows


def _brute(rows):
    """Sequential state machine per user in (time, seq) order."""
    out = {}
    by_user = {}
    for r in rows:
        by_user.setdefault(r[8], []).append(r)
    for u, evs in by_user.items():
        evs.sort(key=lambda r: (r[1], r[0]))
        view_seen = cart_seen = False
        fv = fc = fp = None
        count, revenue = 0, Decimal(0)
        for seq, t, typ, *_rest in evs:
            price = _rest[4]
            if typ == "view":
                view_seen = True
                fv = fv or t
            elif typ == "cart" and view_seen:
                cart_seen = True
                fc = fc or t
            elif typ == "purchase":
                count += 1
                revenue += price
                if cart_seen:
                    fp = fp or t
        out[u] = (int(view_seen), int(cart_seen), int(fp is not None), fv, fc, fp, count, float(revenue))
    return out


def _spark_rows(df):
    return {r.user_id: (r.viewed, r.added_to_cart, r.purchased, r.first_view_time, r.first_cart_time,
                        r.first_purchase_time, r.purchase_count, r.purchase_revenue) for r in df.collect()}


def test_funnel_matches_state_machine(spark):
    rows = _random_events()
    ev = spark.createDataFrame(rows, SCHEMA)
    expected = _brute(rows)
    assert _spark_rows(fn.user_funnel(ev)) == expected
    # the same through ordered slices (time buckets) and through a two-way merge
    assert _spark_rows(fn.sliced_funnel(ev, ["user_id"], F.floor(F.minute("event_time") / 2))) == expected
    a = fn.funnel_partials(ev.where(F.minute("event_time") < 3), ["user_id"])
    b = fn.funnel_partials(ev.where(F.minute("event_time") >= 3), ["user_id"])
    assert _spark_rows(fn.finish(fn.merge_partials(a, b, ["user_id"]), ["user_id"])) == expected
