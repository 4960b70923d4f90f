"""DuckDB oracle SQL for every catalog query.

Written independently of the Spark code, in the plainest SQL form: the
funnel uses the running-window definition (view seen so far → qualifying
cart → qualifying purchase), dedup uses GROUP BY, summaries use SUM.
Tables ``events`` and ``part`` are pre-registered views.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the Spark side).
# ---------------------------------------------------------------------------
BANDS = ["$0", "$0–$50", "$50–$100", "$100–$250", "$250–$500", "$500–$1,000",
         "$1,000–$2,000", "$2,000+", "Unknown"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MIN_VIEWS_SEGMENT = 20
MIN_VIEWS_HOUR = 5
# ---------------------------------------------------------------------------

SHOP_BASE = """shop_base AS (
  SELECT e.event_id AS seq, e.ts AS event_time,
         CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart' ELSE e.event_type END AS event_type,
         CAST(json_extract(e.props,'$.k') AS BIGINT) AS product_id,
         CAST(list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p.p_type) AS BIGINT) AS category_id,
         nullif(p.p_type,'PROMO') AS category_code, nullif(p.p_brand,'Brand#13') AS brand,
         CASE WHEN e.event_id % 97 = 0 THEN CAST(0 AS DECIMAL(14,2))
              ELSE CAST(CAST(e.value AS DECIMAL(12,2))*10 AS DECIMAL(14,2)) END AS price,
         e.user_id,
         CASE WHEN e.event_id % 401 = 0 THEN NULL
              ELSE e.user_id || '-' || strftime(e.ts,'%Y-%m-%d') END AS user_session
  FROM events e LEFT JOIN part p ON p.p_partkey = CAST(json_extract(e.props,'$.k') AS BIGINT))"""

VARIANTS = {
    "base": "shop AS (SELECT * FROM shop_base)",
    "missing_price": "shop AS (SELECT * REPLACE (CASE WHEN seq % 211 = 0 THEN NULL ELSE price END AS price) FROM shop_base)",
    "dirty": "shop AS (SELECT * REPLACE (CASE WHEN seq % 503 = 0 THEN -price ELSE price END AS price) FROM shop_base)",
    "duplicates": """shop AS (SELECT * FROM shop_base
      UNION ALL SELECT * REPLACE (seq + 1000000000 AS seq) FROM shop_base WHERE seq % 50 = 0
      UNION ALL SELECT * REPLACE (seq + 2000000000 AS seq) FROM shop_base WHERE seq % 250 = 0)""",
    "thinned": "shop AS (SELECT * FROM shop_base WHERE NOT (event_type = 'view' AND user_id % 3 = 0))",
    "seconds": "shop AS (SELECT * REPLACE (date_trunc('second', event_time) AS event_time) FROM shop_base)",
    "disordered": """shop AS (SELECT * REPLACE (seq + CASE WHEN seq // 1000 = 1 THEN 1000
                                                  WHEN seq // 1000 = 2 THEN -1000 ELSE 0 END AS seq) FROM shop_base)""",
}

EV9 = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
EV9_DBL = ("seq, event_time, event_type, product_id, category_id, category_code, brand, "
           "CAST(price AS DOUBLE) AS price, user_id, user_session")

CLEAN = """filled AS (SELECT seq, event_time, event_type, product_id, category_id,
        coalesce(category_code,'Unknown') AS category_code, coalesce(brand,'Unknown') AS brand, price, user_id,
        coalesce(user_session,'Unknown') AS user_session FROM shop),
deduped AS (SELECT min(seq) AS seq, """ + EV9 + """ FROM filled GROUP BY ALL),
clean AS (SELECT *, CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS event_hour,
        dayname(event_time) AS day_of_week, CAST(day(event_time) AS INTEGER) AS day_of_month FROM deduped)"""

BAND_CASE = """CASE WHEN price IS NULL THEN 'Unknown' WHEN price = 0 THEN '$0'
  WHEN price <= 50 THEN '$0–$50' WHEN price <= 100 THEN '$50–$100' WHEN price <= 250 THEN '$100–$250'
  WHEN price <= 500 THEN '$250–$500' WHEN price <= 1000 THEN '$500–$1,000' WHEN price <= 2000 THEN '$1,000–$2,000'
  ELSE '$2,000+' END"""

SEG_EXPR = {"category_code": "category_code", "brand": "brand", "price_band": BAND_CASE}


def with_(*ctes: str, variant: str = "base") -> str:
    return "WITH " + ",\n".join([SHOP_BASE, VARIANTS[variant], *ctes]) + "\n"


def funnel_ctes(src: str, seg: str | None = None, out: str = "uf", where: str = "") -> list[str]:
    """Running-window funnel over ``src``; result CTE ``out``."""
    g = f", {seg}" if seg else ""
    segsel = f", {SEG_EXPR[seg]} AS {seg}" if seg else ""
    w = f"(PARTITION BY user_id{g} ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING)"
    return [
        f"{out}_src AS (SELECT *{segsel} FROM {src} {where})",
        f"{out}_v AS (SELECT *, max((event_type='view')::INT) OVER {w} AS vs FROM {out}_src)",
        f"{out}_c AS (SELECT *, (event_type='cart' AND vs=1)::INT AS qc FROM {out}_v)",
        f"{out}_p AS (SELECT *, max(qc) OVER {w} AS cs FROM {out}_c)",
        f"{out}_q AS (SELECT *, (event_type='purchase' AND coalesce(lag(cs) OVER (PARTITION BY user_id{g} ORDER BY event_time, seq), 0)=1)::INT AS qp FROM {out}_p)",
        f"""{out} AS (SELECT user_id{g}, max((event_type='view')::INT) AS viewed, max(qc) AS added_to_cart,
       max(qp) AS purchased,
       min(event_time) FILTER (event_type='view') AS first_view_time,
       min(event_time) FILTER (qc=1) AS first_cart_time, min(event_time) FILTER (qp=1) AS first_purchase_time,
       count(*) FILTER (event_type='purchase') AS purchase_count,
       CAST(coalesce(sum(price) FILTER (event_type='purchase'),0) AS DOUBLE) AS purchase_revenue
  FROM {out}_q GROUP BY user_id{g})""",
    ]


def rates(v="view_users", c="cart_users", p="purchase_users") -> str:
    return (f"CAST({c} AS DOUBLE) / nullif({v}, 0) AS view_to_cart_rate, "
            f"CAST({p} AS DOUBLE) / nullif({c}, 0) AS cart_to_purchase_rate, "
            f"CAST({p} AS DOUBLE) / nullif({v}, 0) AS view_to_purchase_rate")


TOTALS = ("CAST(sum(viewed) AS BIGINT) AS view_users, CAST(sum(added_to_cart) AS BIGINT) AS cart_users, "
          "CAST(sum(purchased) AS BIGINT) AS purchase_users, CAST(sum(purchase_count) AS BIGINT) AS purchase_events, "
          "CAST(sum(CAST(purchase_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue")

BAND_RANK = "CASE price_band " + " ".join(f"WHEN '{b}' THEN {i}" for i, b in enumerate(BANDS, 1)) + " END"
DAY_RANK = "CASE time_value " + " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(WEEKDAYS, 1)) + " END"


def summary_ctes(seg: str, out: str = "ss", variant_src: str = "clean") -> list[str]:
    return funnel_ctes(variant_src, seg, out=f"{out}_f") + [
        f"{out}_t AS (SELECT {seg}, {TOTALS} FROM {out}_f GROUP BY {seg})",
        f"{out} AS (SELECT *, {rates()} FROM {out}_t)",
    ]


TIME_COLS = ("analysis_type, time_dimension, time_value, view_users, cart_users, purchase_users, "
             "purchase_events, revenue, view_to_cart_rate, cart_to_purchase_rate, view_to_purchase_rate")


def time_ctes() -> list[str]:
    hours = "SELECT lpad(CAST(h AS VARCHAR), 2, '0') AS time_value FROM range(24) t(h)"
    days = "SELECT * FROM (VALUES " + ", ".join(f"('{d}')" for d in WEEKDAYS) + ") t(time_value)"
    act = lambda dim, val, spine: f"""SELECT 'purchase_activity' AS analysis_type, '{dim}' AS time_dimension, s.time_value,
        CAST(NULL AS BIGINT) AS view_users, CAST(NULL AS BIGINT) AS cart_users,
        CAST(coalesce(a.pu, 0) AS BIGINT) AS purchase_users, CAST(coalesce(a.pe, 0) AS BIGINT) AS purchase_events,
        coalesce(a.rv, 0.0) AS revenue, CAST(NULL AS DOUBLE) AS view_to_cart_rate,
        CAST(NULL AS DOUBLE) AS cart_to_purchase_rate, CAST(NULL AS DOUBLE) AS view_to_purchase_rate
      FROM ({spine}) s LEFT JOIN (SELECT {val} AS time_value, count(DISTINCT user_id) AS pu, count(*) AS pe,
             CAST(sum(CAST(coalesce(price, 0) AS DECIMAL(18,2))) AS DOUBLE) AS rv
           FROM clean WHERE event_type = 'purchase' GROUP BY 1) a ON a.time_value = s.time_value"""  # noqa: E731
    coh = lambda dim, val: f"""SELECT 'funnel_cohort' AS analysis_type, '{dim}' AS time_dimension, time_value,
        view_users, cart_users, purchase_users, purchase_events, revenue, {rates()}
      FROM (SELECT {val} AS time_value, {TOTALS} FROM uf WHERE viewed = 1 GROUP BY 1)"""  # noqa: E731
    return funnel_ctes("clean") + [
        "coh_h AS (" + coh("hour", "lpad(CAST(hour(first_view_time) AS VARCHAR), 2, '0')") + ")",
        "coh_d AS (" + coh("day_of_week", "dayname(first_view_time)") + ")",
        "act_h AS (" + act("hour", "lpad(CAST(hour(event_time) AS VARCHAR), 2, '0')", hours) + ")",
        "act_d AS (" + act("day_of_week", "dayname(event_time)", days) + ")",
        f"tm AS (SELECT {TIME_COLS} FROM coh_h UNION ALL SELECT {TIME_COLS} FROM coh_d "
        f"UNION ALL SELECT {TIME_COLS} FROM act_h UNION ALL SELECT {TIME_COLS} FROM act_d)",
    ]


def top(table: str, seg: str, by: str, k: int | None, asc: bool = False, where: str = "") -> str:
    order = f"{by} {'ASC' if asc else 'DESC'} NULLS LAST, {seg} ASC"
    lim = f" LIMIT {k}" if k else ""
    return f"SELECT * FROM {table} {where} ORDER BY {order}{lim}"


def report(rows: list[tuple[str, str]], src: str) -> str:
    """One SELECT per check → (check, violations, passed)."""
    parts = [f"SELECT '{n}' AS \"check\", CAST(coalesce(({e}), 0) AS BIGINT) AS violations FROM {src}"
             for n, e in rows]
    return "SELECT \"check\", violations, violations = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


def build() -> dict[str, str]:
    S: dict[str, str] = {}
    base = with_(CLEAN)

    # 1. sources
    S["scan_projected"] = with_() + "SELECT seq, event_time, event_type, CAST(price AS DOUBLE) AS price, user_id FROM shop"
    S["head_sample"] = with_() + f"SELECT {EV9_DBL} FROM shop ORDER BY seq LIMIT 100"
    S["prefix_run"] = with_(CLEAN, *funnel_ctes("clean", where="WHERE seq < 3000")) + "SELECT * FROM uf"

    # 2. cleaning
    S["standardize_types"] = with_() + (
        "SELECT seq, date_trunc('second', event_time) AS event_time, event_type, product_id, category_id, "
        "category_code, brand, CAST(price AS DOUBLE) AS price, user_id, user_session FROM shop")
    S["coerce_lenient"] = with_() + (
        "SELECT seq, CASE WHEN seq % 307 = 0 THEN NULL ELSE date_trunc('second', event_time) END AS event_time, "
        "event_type, CASE WHEN seq % 503 = 0 THEN NULL ELSE product_id END AS product_id, category_id, "
        "category_code, brand, CASE WHEN seq % 211 = 0 THEN NULL ELSE CAST(price AS DOUBLE) END AS price, "
        "user_id, user_session FROM shop")
    S["fill_unknown"] = with_() + (
        "SELECT seq, coalesce(category_code,'Unknown') AS category_code, coalesce(brand,'Unknown') AS brand, "
        "coalesce(user_session,'Unknown') AS user_session FROM shop")
    S["time_features"] = with_() + (
        "SELECT seq, CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INTEGER) AS event_hour, "
        "dayname(event_time) AS day_of_week, CAST(day(event_time) AS INTEGER) AS day_of_month FROM shop")
    S["quality_filter"] = with_(variant="dirty") + (
        f"SELECT {EV9_DBL} FROM shop WHERE NOT (coalesce(price < 0, false) OR coalesce(product_id <= 0, false) "
        "OR coalesce(category_id <= 0, false) OR coalesce(user_id <= 0, false) "
        "OR coalesce(event_type NOT IN ('view','cart','remove_from_cart','purchase'), false))")
    S["clean_events"] = with_(CLEAN, variant="duplicates") + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM clean"
    S["run_summary"] = with_(CLEAN, variant="duplicates") + (
        "SELECT input_rows, output_rows, input_rows - output_rows AS duplicates_removed, "
        "CAST(input_rows - output_rows AS DOUBLE) * 100.0 / nullif(input_rows, 0) AS duplicate_rate_pct FROM "
        "(SELECT (SELECT count(*) FROM shop) AS input_rows, (SELECT count(*) FROM clean) AS output_rows)")

    # 3. dedup
    dup = with_(variant="duplicates")
    S["dedup_exact"] = dup + f"SELECT min(seq) AS seq, {EV9.replace('price', 'CAST(price AS DOUBLE) AS price')} FROM shop GROUP BY ALL"
    texts = ["strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')", "event_type", "CAST(product_id AS VARCHAR)", "CAST(category_id AS VARCHAR)",
             "category_code", "brand", "CAST(price AS VARCHAR)", "CAST(user_id AS VARCHAR)", "user_session"]
    fmt = "md5(" + " || ".join(f"CASE WHEN {t} IS NULL THEN 'N' ELSE CAST(length({t}) AS VARCHAR) || ':' || {t} END" for t in texts) + ")"
    S["event_fingerprint"] = with_() + f"SELECT seq, {fmt} AS fingerprint FROM shop"
    grp = f"g AS (SELECT {EV9}, count(*) AS n FROM shop GROUP BY ALL)"
    S["dup_profile"] = with_(grp, variant="duplicates") + (
        "SELECT count(*) AS distinct_rows, CAST(sum(n) AS BIGINT) AS total_rows, "
        "CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_involved, CAST(sum(n - 1) AS BIGINT) AS excess_rows, "
        "count(*) FILTER (n > 1) AS repeated_keys FROM g")
    S["dup_by_event_type"] = with_(grp, variant="duplicates") + (
        "SELECT event_type, CAST(sum(n) AS BIGINT) AS rows_involved, CAST(sum(n - 1) AS BIGINT) AS excess_rows, "
        "count(DISTINCT user_id) AS users, count(DISTINCT user_session) AS sessions FROM g WHERE n > 1 GROUP BY event_type")
    S["dup_histogram"] = with_(grp, variant="duplicates") + "SELECT n AS copies, count(*) AS keys FROM g GROUP BY n"
    S["dup_examples"] = with_(grp, variant="duplicates") + (
        f"SELECT {EV9_DBL.replace('seq,', 's.seq,').replace('event_time', 's.event_time', 1)} FROM shop s WHERE EXISTS (SELECT 1 FROM g WHERE g.n > 1 AND "
        + " AND ".join(f"g.{c} IS NOT DISTINCT FROM s.{c}" for c in EV9.split(", "))
        + ") ORDER BY s.user_id, s.event_time, s.seq LIMIT 20")

    # 4. funnels
    S["funnel_trace"] = with_(CLEAN, *funnel_ctes("clean")) + (
        "SELECT seq, user_id, event_type, event_time, vs AS view_seen, qc AS qualifying_cart, cs AS cart_seen, "
        "qp AS qualifying_purchase FROM uf_q")
    S["user_funnel"] = with_(CLEAN, *funnel_ctes("clean")) + "SELECT * FROM uf"
    for name, seg in [("category_state", "category_code"), ("brand_state", "brand"), ("price_state", "price_band")]:
        S[name] = with_(CLEAN, *funnel_ctes("clean", seg)) + "SELECT * FROM uf"

    # 5. summaries
    for name, seg in [("category_summary", "category_code"), ("brand_summary", "brand")]:
        S[name] = with_(CLEAN, *summary_ctes(seg)) + f"SELECT * FROM ss ORDER BY revenue DESC, {seg}"
    S["price_band_summary"] = with_(CLEAN, *summary_ctes("price_band")) + \
        f"SELECT *, {BAND_RANK} AS price_band_sort FROM ss ORDER BY price_band_sort"
    uf = with_(CLEAN, *funnel_ctes("clean"))
    S["overall_funnel"] = uf + (
        f"SELECT stage, users, conversion_from_previous, overall_conversion FROM (SELECT {TOTALS} FROM uf) t, "
        "LATERAL (VALUES ('View', 1, view_users, 1.0::DOUBLE, 1.0::DOUBLE), "
        "('Add to Cart', 2, cart_users, CAST(cart_users AS DOUBLE) / nullif(view_users, 0), CAST(cart_users AS DOUBLE) / nullif(view_users, 0)), "
        "('Purchase', 3, purchase_users, CAST(purchase_users AS DOUBLE) / nullif(cart_users, 0), CAST(purchase_users AS DOUBLE) / nullif(view_users, 0))) "
        "v(stage, ord, users, conversion_from_previous, overall_conversion) ORDER BY ord")
    S["revenue_kpis"] = uf + (
        "SELECT total_revenue, purchase_events, purchasing_users, total_revenue / nullif(purchasing_users, 0) AS revenue_per_purchasing_user, "
        "total_revenue / nullif(purchase_events, 0) AS average_purchase_value FROM (SELECT "
        "CAST(sum(CAST(purchase_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, CAST(sum(purchase_count) AS BIGINT) AS purchase_events, "
        "count(*) FILTER (purchase_count > 0) AS purchasing_users FROM uf)")
    S["executive_kpis"] = uf + (
        "SELECT total_users, view_users, cart_users, buyers, purchase_revenue, purchasing_users, "
        f"{rates('view_users', 'cart_users', 'buyers')}, purchase_revenue / nullif(purchasing_users, 0) AS revenue_per_purchasing_user "
        "FROM (SELECT count(*) AS total_users, CAST(sum(viewed) AS BIGINT) AS view_users, CAST(sum(added_to_cart) AS BIGINT) AS cart_users, "
        "CAST(sum(purchased) AS BIGINT) AS buyers, CAST(sum(CAST(purchase_revenue AS DECIMAL(18,2))) AS DOUBLE) AS purchase_revenue, "
        "count(*) FILTER (purchase_count > 0) AS purchasing_users FROM uf)")
    S["purchase_only_users"] = uf + "SELECT * FROM uf WHERE viewed = 0 AND purchase_count > 0"

    # 6. time
    tm = with_(CLEAN, *time_ctes())
    S["cohort_hour"] = tm + f"SELECT {TIME_COLS} FROM coh_h"
    S["cohort_weekday"] = tm + f"SELECT {TIME_COLS} FROM coh_d"
    S["activity_hour"] = tm + f"SELECT {TIME_COLS} FROM act_h"
    S["activity_weekday"] = tm + f"SELECT {TIME_COLS} FROM act_d"
    S["time_analysis"] = tm + f"SELECT *, {DAY_RANK} AS day_order FROM tm"
    S["time_composition"] = tm + "SELECT analysis_type, time_dimension, count(*) AS rows FROM tm GROUP BY ALL"

    # 7. rankings
    cat = with_(CLEAN, *summary_ctes("category_code"))
    br = with_(CLEAN, *summary_ctes("brand"))
    pb = with_(CLEAN, *summary_ctes("price_band"))
    S["top_traffic_category"] = cat + top("ss", "category_code", "view_users", 10)
    S["top_traffic_brand"] = br + top("ss", "brand", "view_users", 10)
    S["top_revenue_category"] = cat + top("ss", "category_code", "revenue", 15)
    S["top_revenue_brand"] = br + top("ss", "brand", "revenue", 20, where="WHERE brand <> 'Unknown'")
    S["best_conversion_category"] = cat + top("ss", "category_code", "view_to_purchase_rate", 10,
                                              where=f"WHERE view_users >= {MIN_VIEWS_SEGMENT}")
    S["best_conversion_brand"] = br + top("ss", "brand", "view_to_purchase_rate", 10,
                                          where=f"WHERE view_users >= {MIN_VIEWS_SEGMENT}")
    for name, seg, sql in [("weak_high_traffic_category", "category_code", cat), ("weak_high_traffic_brand", "brand", br)]:
        S[name] = sql + top("ss", seg, "view_to_purchase_rate", 10, asc=True,
                            where="WHERE view_users >= (SELECT quantile_cont(view_users, 0.75) FROM ss)")
    S["benchmarks"] = cat + (
        "SELECT CAST(quantile_cont(view_users, 0.5) AS DOUBLE) AS median_view_users, "
        "CAST(quantile_cont(view_to_purchase_rate, 0.5) AS DOUBLE) AS median_view_to_purchase_rate, "
        "CAST(quantile_cont(view_users, 0.75) AS DOUBLE) AS p75_view_users FROM ss")
    S["category_opportunities"] = cat + top(
        "ss", "category_code", "view_users", None,
        where="WHERE view_users >= (SELECT quantile_cont(view_users, 0.5) FROM ss) "
              "AND view_to_purchase_rate < (SELECT quantile_cont(view_to_purchase_rate, 0.5) FROM ss)")
    S["category_stars"] = cat + top(
        "ss", "category_code", "revenue", 20,
        where="WHERE view_users >= (SELECT quantile_cont(view_users, 0.5) FROM ss) "
              "AND view_to_purchase_rate >= (SELECT quantile_cont(view_to_purchase_rate, 0.5) FROM ss)")
    S["brand_opportunities"] = with_(CLEAN, *summary_ctes("brand"), "kb AS (SELECT * FROM ss WHERE brand <> 'Unknown')") + top(
        "kb", "brand", "view_users", None,
        where="WHERE view_users >= (SELECT quantile_cont(view_users, 0.75) FROM kb) "
              "AND view_to_purchase_rate < (SELECT quantile_cont(view_to_purchase_rate, 0.5) FROM kb)")
    S["paid_bands"] = pb + top("ss", "price_band", "view_to_purchase_rate", None, where="WHERE price_band <> '$0'")
    S["paid_bands_revenue"] = pb + top("ss", "price_band", "revenue", None, where="WHERE price_band <> '$0'")
    S["high_value_weakest"] = pb + top("ss", "price_band", "view_to_purchase_rate", None, asc=True,
                                       where="WHERE price_band IN ('$1,000–$2,000', '$2,000+')")
    S["zero_band"] = pb + "SELECT * FROM ss WHERE price_band = '$0'"
    S["best_hours"] = tm + top("tm", "time_value", "view_to_purchase_rate", 10,
                               where=f"WHERE analysis_type = 'funnel_cohort' AND time_dimension = 'hour' AND view_users >= {MIN_VIEWS_HOUR}")
    S["best_days"] = tm + top("tm", "time_value", "view_to_purchase_rate", None,
                              where="WHERE analysis_type = 'funnel_cohort' AND time_dimension = 'day_of_week'")
    S["top_purchase_hours"] = tm + top("tm", "time_value", "revenue", 10,
                                       where="WHERE analysis_type = 'purchase_activity' AND time_dimension = 'hour'")
    S["top_purchase_days"] = tm + top("tm", "time_value", "revenue", None,
                                      where="WHERE analysis_type = 'purchase_activity' AND time_dimension = 'day_of_week'")
    S["quadrants"] = with_(CLEAN, *summary_ctes("brand"),
                           f"qb AS (SELECT * FROM ss WHERE view_users >= {MIN_VIEWS_SEGMENT} AND revenue > 0)") + (
        "SELECT brand, view_users, revenue, view_to_purchase_rate, view_to_purchase_rate * 100 AS view_to_purchase_pct, "
        "revenue / 1000000 AS revenue_millions, CASE "
        "WHEN revenue >= (SELECT quantile_cont(revenue, 0.5) FROM qb) AND view_to_purchase_rate >= (SELECT quantile_cont(view_to_purchase_rate, 0.5) FROM qb) THEN 'strong performer' "
        "WHEN revenue >= (SELECT quantile_cont(revenue, 0.5) FROM qb) THEN 'optimization opportunity' "
        "WHEN view_to_purchase_rate >= (SELECT quantile_cont(view_to_purchase_rate, 0.5) FROM qb) THEN 'scalable performer' "
        "ELSE 'lower priority' END AS quadrant FROM qb")
    S["segment_lookup"] = br + "SELECT * FROM ss WHERE lower(brand) = 'brand#22'"

    # 8. profiling
    sh = with_()
    S["row_count"] = sh + "SELECT count(*) AS rows FROM shop"
    S["event_distribution"] = sh + "SELECT event_type, count(*) AS events FROM shop GROUP BY event_type ORDER BY events DESC"
    S["distinct_counts"] = sh + (
        "SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_session) AS sessions, "
        "count(DISTINCT product_id) AS products, count(DISTINCT category_id) AS categories FROM shop")
    S["min_max"] = sh + (
        "SELECT min(event_time) AS min_event_time, max(event_time) AS max_event_time, "
        "CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price FROM shop")
    cols = EV9.split(", ")
    S["missing_profile"] = with_(variant="missing_price") + "SELECT column_name, missing, missing * 100.0 / nullif(n, 0) AS missing_pct FROM (" + \
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing, count(*) AS n FROM shop" for c in cols) + \
        ") ORDER BY missing DESC, column_name"
    S["missing_by_event"] = sh + (
        "SELECT event_type, count(*) FILTER (category_code IS NULL) AS missing_category_code, "
        "count(*) FILTER (brand IS NULL) AS missing_brand FROM shop GROUP BY event_type")
    S["zero_price_profile"] = sh + (
        "SELECT count(*) AS rows, count(*) FILTER (price = 0) AS zero_price_rows, "
        "count(DISTINCT product_id) FILTER (price = 0) AS zero_price_products, "
        "count(*) FILTER (price = 0) * 100.0 / nullif(count(*), 0) AS zero_price_pct FROM shop")
    S["zero_price_by_event"] = sh + "SELECT event_type, count(*) AS zero_price_rows FROM shop WHERE price = 0 GROUP BY event_type"
    for name, c in [("zero_price_top_category", "category_code"), ("zero_price_top", "category_code"),
                    ("zero_price_top_brand", "brand")]:
        S[name] = with_(CLEAN) + (f"SELECT {c}, count(*) AS rows FROM clean WHERE price = 0 AND {c} IS NOT NULL "
                                  f"GROUP BY {c} ORDER BY rows DESC, {c} LIMIT 20")

    # 9. validation
    S["validate_user_funnel"] = uf + report([
        ("duplicate_key", "SELECT count(*) FROM (SELECT user_id FROM uf GROUP BY user_id HAVING count(*) > 1)"),
        ("missing_key", "SELECT count(*) FILTER (user_id IS NULL) FROM uf"),
        ("negative_purchase_count", "SELECT count(*) FILTER (purchase_count < 0) FROM uf"),
        ("negative_purchase_revenue", "SELECT count(*) FILTER (purchase_revenue < 0) FROM uf"),
        ("cart_without_view", "SELECT count(*) FILTER (added_to_cart = 1 AND viewed = 0) FROM uf"),
        ("purchase_without_cart", "SELECT count(*) FILTER (purchased = 1 AND added_to_cart = 0) FROM uf"),
        ("purchased_without_events", "SELECT count(*) FILTER (purchased = 1 AND purchase_count = 0) FROM uf"),
    ], "(SELECT 1)")

    def rate_chk(n, d, r):
        return f"count(*) FILTER ({d} > 0 AND ({r} IS NULL OR abs({r} - CAST({n} AS DOUBLE) / {d}) > 1e-10))"

    def summary_checks(key):
        rows = [("required_columns", "SELECT 0"),
                ("duplicate_key", f"SELECT count(*) FROM (SELECT {key} FROM ss GROUP BY {key} HAVING count(*) > 1)"),
                ("missing_key", f"SELECT count(*) FILTER ({key} IS NULL) FROM ss")]
        rows += [(f"negative_{c}", f"SELECT count(*) FILTER ({c} < 0) FROM ss")
                 for c in ["view_users", "cart_users", "purchase_users", "purchase_events", "revenue"]]
        rows += [("cart_gt_view", "SELECT count(*) FILTER (cart_users > view_users) FROM ss"),
                 ("purchase_gt_cart", "SELECT count(*) FILTER (purchase_users > cart_users) FROM ss"),
                 ("purchase_gt_view", "SELECT count(*) FILTER (purchase_users > view_users) FROM ss"),
                 ("rate_view_to_cart", "SELECT " + rate_chk("cart_users", "view_users", "view_to_cart_rate") + " FROM ss"),
                 ("rate_cart_to_purchase", "SELECT " + rate_chk("purchase_users", "cart_users", "cart_to_purchase_rate") + " FROM ss"),
                 ("rate_view_to_purchase", "SELECT " + rate_chk("purchase_users", "view_users", "view_to_purchase_rate") + " FROM ss"),
                 ("undefined_rate_vs_zero_cart", "SELECT abs(count(*) FILTER (cart_to_purchase_rate IS NULL) - count(*) FILTER (cart_users = 0)) FROM ss"),
                 ("purchases_without_revenue", "SELECT count(*) FILTER (purchase_events > 0 AND revenue = 0) FROM ss")]
        return rows

    S["validate_category"] = cat + report(summary_checks("category_code"), "(SELECT 1)")
    S["validate_brand"] = br + report(summary_checks("brand"), "(SELECT 1)")
    band_list = ", ".join(f"'{b}'" for b in BANDS)
    S["validate_price"] = pb + "SELECT * FROM (" + report(summary_checks("price_band") + [
        ("unexpected_band", f"SELECT count(*) FILTER (price_band NOT IN ({band_list})) FROM ss")], "(SELECT 1)") + \
        f") UNION ALL SELECT 'absent_band', CAST(count(*) AS BIGINT), true FROM (SELECT unnest([{band_list}]) AS b) x " \
        "WHERE b NOT IN (SELECT price_band FROM ss)"
    hours = ", ".join(f"'{h:02d}'" for h in range(24))
    days = ", ".join(f"'{d}'" for d in WEEKDAYS)
    cnts = ["view_users", "cart_users", "purchase_users", "purchase_events", "revenue"]
    time_rows = [
        ("required_columns", "SELECT 0"),
        ("duplicate_key", "SELECT count(*) FROM (SELECT 1 FROM tm GROUP BY analysis_type, time_dimension, time_value HAVING count(*) > 1)"),
        ("row_count_vs_expected", "SELECT abs(count(*) - 62) FROM tm"),
        ("unexpected_analysis_type", "SELECT count(*) FILTER (analysis_type NOT IN ('funnel_cohort', 'purchase_activity')) FROM tm"),
        ("unexpected_dimension", "SELECT count(*) FILTER (time_dimension NOT IN ('hour', 'day_of_week')) FROM tm"),
        ("unexpected_hour", f"SELECT count(*) FILTER (time_dimension = 'hour' AND coalesce(time_value NOT IN ({hours}), true)) FROM tm"),
        ("unexpected_weekday", f"SELECT count(*) FILTER (time_dimension = 'day_of_week' AND coalesce(time_value NOT IN ({days}), true)) FROM tm"),
        ("missing_analysis_type", "SELECT 2 - count(DISTINCT analysis_type) FILTER (analysis_type IN ('funnel_cohort', 'purchase_activity')) FROM tm"),
        ("missing_dimension", "SELECT 2 - count(DISTINCT time_dimension) FILTER (time_dimension IN ('hour', 'day_of_week')) FROM tm"),
        ("missing_hour", f"SELECT 24 - count(DISTINCT time_value) FILTER (time_dimension = 'hour' AND time_value IN ({hours})) FROM tm"),
        ("missing_weekday", f"SELECT 7 - count(DISTINCT time_value) FILTER (time_dimension = 'day_of_week' AND time_value IN ({days})) FROM tm"),
        ("activity_hours_vs_24", "SELECT abs(count(*) FILTER (analysis_type = 'purchase_activity' AND time_dimension = 'hour') - 24) FROM tm"),
        ("activity_days_vs_7", "SELECT abs(count(*) FILTER (analysis_type = 'purchase_activity' AND time_dimension = 'day_of_week') - 7) FROM tm"),
        ("negative_metrics", "SELECT count(*) FILTER (" + " OR ".join(f"{c} < 0" for c in cnts) + ") FROM tm"),
        ("hierarchy", "SELECT count(*) FILTER (analysis_type = 'funnel_cohort' AND (cart_users > view_users OR purchase_users > cart_users)) FROM tm"),
        ("rate_recompute", "SELECT " + " + ".join([rate_chk("cart_users", "view_users", "view_to_cart_rate"),
                                                  rate_chk("purchase_users", "cart_users", "cart_to_purchase_rate"),
                                                  rate_chk("purchase_users", "view_users", "view_to_purchase_rate")]) + " FROM tm"),
        ("activity_funnel_fields_not_null", "SELECT count(*) FILTER (analysis_type = 'purchase_activity' AND (view_users IS NOT NULL OR "
         "cart_users IS NOT NULL OR view_to_cart_rate IS NOT NULL OR cart_to_purchase_rate IS NOT NULL OR view_to_purchase_rate IS NOT NULL)) FROM tm"),
    ]
    S["validate_time"] = tm + report(time_rows, "(SELECT 1)")
    S["reconcile"] = tm + report([
        ("cohort_view_users", "SELECT abs((SELECT sum(view_users) FROM coh_h) - (SELECT sum(viewed) FROM uf))"),
        ("cohort_cart_users", "SELECT abs((SELECT sum(cart_users) FROM coh_h) - (SELECT sum(added_to_cart) FROM uf))"),
        ("cohort_purchase_users", "SELECT abs((SELECT sum(purchase_users) FROM coh_h) - (SELECT sum(purchased) FROM uf))"),
        ("activity_purchase_events", "SELECT abs((SELECT sum(purchase_events) FROM act_h) - (SELECT count(*) FROM clean WHERE event_type = 'purchase'))"),
        ("activity_revenue", "SELECT CAST(abs((SELECT sum(CAST(revenue AS DECIMAL(18,2))) FROM act_h) - (SELECT sum(CAST(coalesce(price, 0) AS DECIMAL(18,2))) FROM clean WHERE event_type = 'purchase')) > 0.01 AS INT)"),
    ], "(SELECT 1)")
    qual_rows = [
        ("negative_price", "SELECT count(*) FILTER (price < 0) FROM shop"),
        ("nonpositive_product_id", "SELECT count(*) FILTER (product_id <= 0) FROM shop"),
        ("nonpositive_category_id", "SELECT count(*) FILTER (category_id <= 0) FROM shop"),
        ("nonpositive_user_id", "SELECT count(*) FILTER (user_id <= 0) FROM shop"),
        ("null_critical_field", "SELECT count(*) FILTER (event_time IS NULL OR event_type IS NULL OR product_id IS NULL OR user_id IS NULL) FROM shop"),
        ("null_price", "SELECT count(*) FILTER (price IS NULL) FROM shop"),
        ("null_category_id", "SELECT count(*) FILTER (category_id IS NULL) FROM shop"),
        ("unexpected_event_type", "SELECT count(*) FILTER (event_type NOT IN ('view','cart','remove_from_cart','purchase')) FROM shop"),
    ]
    S["quality_report"] = (with_(variant="dirty") + "SELECT * FROM (" + report(qual_rows, "(SELECT 1)") + ") UNION ALL " +
                           "SELECT * FROM (" + with_(CLEAN, variant="duplicates") + report(
                               [("remaining_duplicates", f"SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM clean GROUP BY {EV9})")],
                               "(SELECT 1)") + ")")
    S["order_check"] = with_("per AS (SELECT seq // 1000 AS chunk, min(event_time) AS min_time, max(event_time) AS max_time FROM shop GROUP BY 1)",
                             variant="disordered") + (
        "SELECT a.chunk, a.min_time, a.max_time, b.max_time AS prev_max_time, coalesce(a.min_time >= b.max_time, true) AS in_order "
        "FROM per a LEFT JOIN per b ON b.chunk + 1 = a.chunk")

    # 10. incremental
    mid = "(SELECT floor((max(seq // 1000) + 1) / 2) FROM clean)"
    S["state_semi"] = with_(CLEAN, *funnel_ctes("clean", where=f"WHERE seq // 1000 < {mid}")) + (
        f"SELECT * FROM uf WHERE user_id IN (SELECT user_id FROM clean WHERE seq // 1000 >= {mid})")
    S["state_merge"] = S["user_funnel"]
    S["incremental_funnel"] = S["user_funnel"]
    S["incremental_category"] = S["category_state"]
    S["incremental_brand"] = S["brand_state"]
    S["incremental_price"] = S["price_state"]
    S["state_size"] = with_(CLEAN, *funnel_ctes("clean", "category_code")) + "SELECT count(*) AS state_rows FROM uf"
    mid_base = "(SELECT floor((max(seq // 1000) + 1) / 2) FROM shop_base)"
    S["seen_anti"] = with_(variant="duplicates") + (
        f"SELECT min(seq) AS seq, {EV9.replace('price', 'CAST(price AS DOUBLE) AS price')} FROM shop s "
        f"WHERE seq // 1000 >= {mid_base} AND NOT EXISTS (SELECT 1 FROM shop o WHERE o.seq // 1000 < {mid_base} AND "
        + " AND ".join(f"o.{c} IS NOT DISTINCT FROM s.{c}" for c in EV9.split(", ")) + ") GROUP BY ALL")
    # 11. streaming (compared with the batch definitions)
    S["stream_dedup"] = with_(variant="duplicates") + (
        "SELECT DISTINCT event_time, event_type, product_id, category_id, coalesce(category_code,'Unknown') AS category_code, "
        "coalesce(brand,'Unknown') AS brand, CAST(price AS DOUBLE) AS price, user_id, coalesce(user_session,'Unknown') AS user_session FROM shop")
    S["stream_funnel"] = S["user_funnel"]
    S["stream_funnel_state"] = S["user_funnel"]
    S["stream_activity"] = tm + "SELECT time_value, purchase_users, purchase_events, revenue FROM act_h"

    # 12. sinks
    S["roundtrip_parquet"] = with_(CLEAN) + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM clean"
    # 13. text sources / sinks and remaining inventory items
    S["csv_scan"] = with_() + (
        "SELECT date_trunc('second', event_time) AS event_time, event_type, product_id, category_id, "
        "category_code, brand, CAST(price AS DOUBLE) AS price, user_id, user_session FROM shop")
    S["csv_funnel"] = with_(CLEAN, *funnel_ctes("clean"), variant="seconds") + "SELECT * FROM uf"
    S["csv_indexed_funnel"] = S["csv_funnel"]
    S["csv_prefix_run"] = with_(CLEAN, *funnel_ctes("clean", where="WHERE seq < 3000"), variant="seconds") + "SELECT * FROM uf"
    S["funnel_result_load"] = S["cohort_hour"]
    S["summary_csv"] = S["category_summary"]
    S["state_semi_category"] = with_(CLEAN, *funnel_ctes("clean", "category_code", where=f"WHERE seq // 1000 < {mid}")) + (
        f"SELECT * FROM uf WHERE (user_id, category_code) IN (SELECT (user_id, category_code) FROM clean WHERE seq // 1000 >= {mid})")
    S["bucketed_upsert"] = S["replayed_batches"] = S["user_funnel"]
    batch5 = "seq * 5 // (SELECT max(seq) + 1 FROM shop)"
    late = with_(f"batched AS (SELECT *, CAST({batch5} AS INTEGER) AS batch FROM shop)",
                 "tops AS (SELECT batch, max(event_time) AS hi FROM batched GROUP BY batch)",
                 "marked AS (SELECT b.*, coalesce(b.event_time < (SELECT max(hi) FROM tops t WHERE t.batch < b.batch), false) AS late FROM batched b)",
                 "on_time AS (SELECT * FROM marked WHERE NOT late)", variant="disordered")
    S["late_rows"] = late + "SELECT batch, seq, user_id, event_type, event_time FROM marked WHERE late"
    S["late_rows_funnel"] = late.rstrip() + ",\n" + ",\n".join(funnel_ctes("on_time")) + "\nSELECT * FROM uf"
    S["seen_store"] = with_(variant="duplicates") + f"SELECT DISTINCT {EV9.replace('price', 'CAST(price AS DOUBLE) AS price')} FROM shop"
    S["clean_append"] = S["roundtrip_parquet"]
    kinds = [("user", None), ("category", "category_code"), ("brand", "brand"), ("price_band", "price_band")]
    cols = "viewed, added_to_cart, purchased, first_view_time, first_cart_time, first_purchase_time, purchase_count, purchase_revenue"
    S["funnels_all"] = with_(CLEAN, *[c for k, seg in kinds for c in funnel_ctes("clean", seg, out=f"f_{k}")]) + " UNION ALL ".join(
        f"SELECT user_id, '{k}' AS segment_type, {seg or repr('')} AS segment, {cols} FROM f_{k}" for k, seg in kinds)
    S["activity_bitmap_merge"] = tm + f"SELECT {TIME_COLS} FROM act_h UNION ALL SELECT {TIME_COLS} FROM act_d"
    S["distinct_bitmap"] = S["distinct_counts"]
    S["distinct_sketch"] = sh + " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, count(DISTINCT {a}) AS exact, true AS within_bound FROM shop" for a in ("user_id", "user_session", "product_id"))
    ill = "seq % 101 = 0 OR seq % 103 = 0"
    odd = "seq % 107 = 0 OR seq % 109 = 0"
    S["csv_quarantine"] = sh + (
        f"SELECT 'read' AS check, count(*) AS rows FROM shop UNION ALL SELECT 'kept', count(*) FROM shop WHERE NOT ({ill} OR {odd}) "
        f"UNION ALL SELECT 'set_aside_fields', count(*) FROM shop WHERE {ill} "
        f"UNION ALL SELECT 'set_aside_unparsable', count(*) FROM shop WHERE ({odd}) AND NOT ({ill})")
    S["csv_quarantine_funnel"] = with_(f"kept AS (SELECT * FROM shop WHERE NOT ({ill} OR {odd}))", CLEAN.replace("FROM shop)", "FROM kept)"),
                                       *funnel_ctes("clean"), variant="seconds") + "SELECT * FROM uf"
    S["input_report"] = ("SELECT 'events' AS input, true AS present UNION ALL SELECT 'part', true UNION ALL SELECT 'clean_events', false")
    S["incremental_upsert"] = S["user_funnel"]
    S["dup_marks"] = with_(variant="duplicates") + (
        f"SELECT seq, seq <> min(seq) OVER (PARTITION BY {EV9}) AS duplicate_after_first, "
        f"count(*) OVER (PARTITION BY {EV9}) > 1 AS duplicate_any FROM shop")
    S["zero_price_examples"] = with_() + f"SELECT {EV9_DBL} FROM shop WHERE price = 0 ORDER BY user_id, event_time, seq LIMIT 20"
    S["negative_price_examples"] = with_(variant="dirty") + f"SELECT {EV9_DBL} FROM shop WHERE price < 0 ORDER BY user_id, event_time, seq LIMIT 20"
    S["set_difference_bands"] = pb + (
        f"SELECT b AS price_band, 'missing' AS side FROM (SELECT unnest([{band_list}]) AS b) WHERE b NOT IN (SELECT price_band FROM ss) "
        f"UNION ALL SELECT price_band, 'unexpected' FROM ss WHERE price_band NOT IN ({band_list})")
    S["kpi_table"] = uf + (
        "SELECT metric, value FROM (SELECT total_revenue, CAST(purchase_events AS DOUBLE) AS purchase_events, "
        "CAST(purchasing_users AS DOUBLE) AS purchasing_users, total_revenue / nullif(purchasing_users, 0) AS revenue_per_purchasing_user, "
        "total_revenue / nullif(purchase_events, 0) AS average_purchase_value FROM (SELECT "
        "CAST(sum(CAST(purchase_revenue AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, CAST(sum(purchase_count) AS BIGINT) AS purchase_events, "
        "count(*) FILTER (purchase_count > 0) AS purchasing_users FROM uf)) "
        "UNPIVOT (value FOR metric IN (total_revenue, purchase_events, purchasing_users, revenue_per_purchasing_user, average_purchase_value))")
    tcols = TIME_COLS.split(", ")
    S["time_null_summary"] = tm + "SELECT column_name, missing, missing * 100.0 / nullif(n, 0) AS missing_pct FROM (" + \
        " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing, count(*) AS n FROM tm" for c in tcols) + ")"
    S["category_lookup"] = cat + "SELECT * FROM ss WHERE category_code = 'LARGE'"
    S["stage_flags"] = with_() + (
        "SELECT seq, (event_type = 'view')::INT AS is_view, (event_type = 'cart')::INT AS is_cart, "
        "(event_type = 'purchase')::INT AS is_purchase FROM shop")
    S["stream_category"] = S["category_state"]
    S["stream_brand"] = S["brand_state"]
    S["stream_price"] = S["price_state"]
    S["stream_dedup_watermark"] = S["stream_dedup"]
    S["stream_profile"] = with_() + (
        "SELECT event_type, count(*) AS events, count(*) FILTER (price = 0) AS zero_price_rows, "
        "count(*) FILTER (category_code IS NULL) AS unknown_category_code, count(*) FILTER (brand IS NULL) AS unknown_brand "
        "FROM shop GROUP BY event_type")
    S["price_band_summary_missing"] = with_(CLEAN, *summary_ctes("price_band"), variant="missing_price") + \
        f"SELECT *, {BAND_RANK} AS price_band_sort FROM ss ORDER BY price_band_sort"
    qclean = CLEAN.replace("FROM shop),", "FROM shop WHERE NOT (coalesce(price < 0, false) OR coalesce(product_id <= 0, false) "
                           "OR coalesce(category_id <= 0, false) OR coalesce(user_id <= 0, false) "
                           "OR coalesce(event_type NOT IN ('view','cart','remove_from_cart','purchase'), false))),", 1)
    # 14. later additions
    S["stream_activity_weekday"] = tm + "SELECT time_value, purchase_users, purchase_events, revenue FROM act_d"
    S["stream_missing"] = with_(variant="missing_price") + "SELECT count(*) AS rows, " + ", ".join(
        f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in cols) + " FROM shop"
    S["dup_involvement"] = with_(grp, variant="duplicates") + (
        "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_involved, count(DISTINCT user_id) AS users, "
        "count(DISTINCT user_session) AS sessions FROM g WHERE n > 1")
    S["state_left_fill"] = with_(CLEAN, *funnel_ctes("clean", where=f"WHERE seq // 1000 < {mid} AND user_id % 2 = 0")) + (
        "SELECT b.user_id, coalesce(uf.viewed, 0) AS viewed, coalesce(uf.purchase_count, 0) AS purchase_count, "
        "coalesce(uf.purchase_revenue, 0.0) AS purchase_revenue "
        f"FROM (SELECT DISTINCT user_id FROM clean WHERE seq // 1000 >= {mid}) b LEFT JOIN uf ON uf.user_id = b.user_id")
    S["seen_insert"] = with_(variant="duplicates") + f"SELECT DISTINCT {fmt} AS fingerprint FROM shop"
    thin = with_(CLEAN, *funnel_ctes("clean"), variant="thinned")
    S["user_funnel_thinned"] = thin + "SELECT * FROM uf"
    S["purchase_only_users_thinned"] = S["purchase_only_users"].replace(uf, thin)
    S["overall_funnel_thinned"] = S["overall_funnel"].replace(uf, thin)

    def faulty(columns, src, faults, again, where="true"):
        picked = ", ".join(f"CASE WHEN {faults[c][0]} THEN {faults[c][1]} ELSE {c} END AS {c}" if c in faults else c for c in columns)
        return f"bad AS (SELECT {picked} FROM {src} WHERE {where}), ss AS (SELECT * FROM bad UNION ALL SELECT * FROM bad WHERE {again})"

    counted = ["view_users", "cart_users", "purchase_users", "purchase_events", "revenue",
               "view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate"]
    S["validate_category_faulty"] = with_(CLEAN, *summary_ctes("category_code", out="ok"), faulty(["category_code", *counted], "ok", {
        "cart_users": ("category_code = 'SMALL'", "view_users + 1"),
        "purchase_users": ("category_code = 'STANDARD'", "view_users + 2"),
        "purchase_events": ("category_code = 'MEDIUM'", "-1"),
        "revenue": ("category_code = 'ECONOMY'", "0.0"),
        "category_code": ("category_code = 'Unknown'", "NULL"),
    }, "category_code = 'LARGE'")) + report(summary_checks("category_code"), "(SELECT 1)")
    user_cols = ["user_id", "viewed", "added_to_cart", "purchased", "purchase_count", "purchase_revenue"]
    S["validate_user_funnel_faulty"] = S["validate_user_funnel"].replace(uf, with_(CLEAN, *funnel_ctes("clean", out="ok"), faulty(user_cols, "ok", {
        "viewed": ("user_id % 7 = 0", "0"),
        "added_to_cart": ("user_id % 5 = 0", "0"),
        "purchase_count": ("user_id % 11 = 0", "-1"),
        "purchase_revenue": ("user_id % 13 = 0", "-0.5"),
    }, "user_id % 17 = 0"), "uf AS (SELECT * FROM ss)"))
    bad_time = with_(CLEAN, *[c.replace("tm AS (", "all_times AS (", 1) if c.startswith("tm AS (") else c for c in time_ctes()],
                     faulty(tcols, "all_times", {
                         "time_value": ("time_value = 'Monday' OR (time_value = '05' AND analysis_type = 'funnel_cohort')",
                                        "CASE WHEN time_value = 'Monday' THEN 'Mon' END"),
                         "cart_users": ("time_value = 'Friday' AND analysis_type = 'funnel_cohort'", "view_users + 1"),
                         "revenue": ("time_value = '07'", "-1.0"),
                     }, "time_value = '11'", "time_value NOT IN ('03', '04')"), "tm AS (SELECT * FROM ss)")
    S["validate_time_faulty"] = bad_time + report(time_rows, "(SELECT 1)")
    labels = ("SELECT a.analysis_type, x.time_dimension, x.time_value FROM (VALUES ('funnel_cohort'), ('purchase_activity')) a(analysis_type), "
              f"(SELECT 'hour' AS time_dimension, unnest([{hours}]) AS time_value UNION ALL SELECT 'day_of_week', unnest([{days}])) x")
    keys = "analysis_type, time_dimension, time_value"
    S["time_label_differences"] = bad_time + (
        f"SELECT *, 'missing' AS side FROM (({labels}) EXCEPT SELECT {keys} FROM tm) "
        f"UNION ALL SELECT *, 'unexpected' FROM (SELECT {keys} FROM tm EXCEPT ({labels}))")
    S["clean_quality"] = with_(qclean, variant="dirty") + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM clean"
    return S


ORACLE_SQL = build()
