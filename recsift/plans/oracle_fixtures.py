"""DuckDB SQL twins of ``recsift.sources.fixtures`` (same definitions, same floating-point order)."""

from __future__ import annotations

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

FIXTURE_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "tx": ((), """
        SELECT CAST(o.o_custkey AS VARCHAR) AS user_id, CAST(l.l_partkey AS VARCHAR) AS item_id,
               l.l_linenumber AS line_no, o.o_orderdate AS ts, strftime(o.o_orderdate, '%Y%m%d') AS ymd
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "ext": ((), f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id, CAST({_K} AS VARCHAR) AS item_id,
               CASE WHEN event_type = 'error' THEN 'footprint' WHEN event_type = 'purchase' THEN 'order'
                    ELSE 'other' END AS type,
               (epoch_us(ts) // 1000) AS time, strftime(ts, '%Y%m%d') AS ymd
        FROM events"""),
    "ev": ((), f"""
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST({_K} AS VARCHAR) AS item_id,
               CAST({_K} + 1000000 AS VARCHAR) AS offer_id,
               CASE event_type WHEN 'click' THEN 'coupon_click' WHEN 'view' THEN 'coupon_view'
                    WHEN 'purchase' THEN 'buy_detail' WHEN 'signup' THEN 'collect_detail'
                    WHEN 'error' THEN 'footprint' END AS event_name,
               CASE WHEN event_type = 'view' THEN 'view' ELSE 'click' END AS event_type,
               (epoch_us(ts) // 1000) AS event_time, strftime(ts, '%Y%m%d') AS ymd, strftime(ts, '%Y%m%d%H') AS ymdh
        FROM events"""),
    "cat": ((), """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, CAST(p_partkey + 1000000 AS VARCHAR) AS offer_id,
               p_partkey % 10 AS shop_id,
               CASE WHEN p_partkey % 20 = 19 THEN 0 ELSE 1 END AS status,
               CASE WHEN p_type = 'PROMO' THEN 2 ELSE 1 END AS product_type,
               p_brand AS subcate_id, p_size AS cate_id3, p_partkey % 5 AS is_recommend,
               p_retailprice * ((p_partkey % 10) + 1) / CAST(50.0 AS DOUBLE) AS raw_price,
               (p_retailprice * ((p_partkey % 10) + 1) / CAST(50.0 AS DOUBLE))
                   * (1 - (p_partkey % 8) * CAST(0.05 AS DOUBLE)) AS zk_price,
               p_size * 10 AS order_count, p_size AS month_sales, p_partkey % 13 AS ticket_id,
               p_name AS title
        FROM part"""),
    "ost": ((), """
        SELECT CAST(p_partkey + 1000000 AS VARCHAR) AS offer_id,
               CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS is_del
        FROM part WHERE p_partkey % 23 <> 22"""),
    "shop": ((), """
        SELECT s_suppkey AS shop_id, CASE WHEN s_suppkey % 9 = 8 THEN 1 ELSE 0 END AS is_del,
               CAST(4.0 AS DOUBLE) + (s_suppkey % 5) * CAST(0.25 AS DOUBLE) AS shop_score_avg
        FROM supplier"""),
    "tkt": (("cat",), """
        SELECT ticket_id, CASE WHEN ticket_id = 7 THEN 0 ELSE 1 END AS status
        FROM (SELECT DISTINCT ticket_id FROM cat) t"""),
    "tlog": ((), f"""
        SELECT CASE WHEN event_type IN ('click', 'purchase') THEN '1' ELSE '0' END AS label,
               '{{"S": ' || CAST(k + 1000000 AS VARCHAR) || ', "Sc": ' || CAST(k % 7 AS VARCHAR)
               || ', "Sd": ' || CAST(user_id AS VARCHAR)
               || CASE WHEN k % 11 = 0 THEN '' ELSE ', "Se": ' || CAST(k % 11 AS VARCHAR) END
               || ', "Sm": ' || CASE WHEN k % 13 = 0 THEN '""' ELSE CAST(k % 13 AS VARCHAR) END
               || ', "Mc": ' || CAST(k % 6 AS VARCHAR) || ', "Sl": ' || CAST(k AS VARCHAR)
               || ', "Sf": ' || CAST(k * 3 AS VARCHAR) || ', "Ss": ' || CAST(k % 45 AS VARCHAR)
               || CASE WHEN k % 17 = 5 THEN '' ELSE ', "Sq": "' || array_to_string(range(k * 1000, k * 1000 + k % 60), ',') || '"' END
               || '}}' AS predictor_json,
               CAST(event_id // 4 AS VARCHAR) AS trace_id,
               CASE WHEN user_id % 10 = 3 THEN CAST(user_id AS VARCHAR)
                    ELSE lpad(CAST(user_id AS VARCHAR), 14, '0') END AS user_id,
               CAST(k + 1000000 AS VARCHAR) AS offer_id,
               CASE WHEN event_type = 'error' THEN 'search' ELSE 'home_feed' END AS log_type,
               strftime(ts, '%Y%m%d') AS day
        FROM (SELECT *, {_K} AS k FROM events) e"""),
    "cx": (("tx",), """
        SELECT CASE WHEN CAST(tx.user_id AS BIGINT) % 10 = 3 THEN tx.user_id ELSE lpad(tx.user_id, 14, '0') END AS user_id,
               tx.item_id, CAST(p.p_partkey + 1000000 AS VARCHAR) AS offer_id,
               CASE WHEN p.p_partkey % 50 = 7 THEN NULL ELSE p.p_brand END AS subcate_id,
               CAST(p.p_size AS VARCHAR) AS cate_id3, 'coupon_click' AS event_name, 'click' AS event_type,
               CASE WHEN tx.line_no % 4 = 0 THEN 'h5_subsidy' WHEN tx.line_no % 7 = 0 THEN 'h5_free' ELSE 'home' END AS cur_page,
               CASE WHEN tx.line_no % 5 = 0 THEN 'home_free_list' ELSE 'feed' END AS cur_module,
               tx.ymd
        FROM tx JOIN part p ON tx.item_id = CAST(p.p_partkey AS VARCHAR)"""),
}


#: Catalog and offer status where items have several offers and categories, over the plain ones.
FAN_SQL = {
    "cat": """SELECT * FROM one_cat
              UNION ALL SELECT * REPLACE (CAST(CAST(item_id AS BIGINT) + 2000000 AS VARCHAR) AS offer_id)
                        FROM one_cat WHERE CAST(item_id AS BIGINT) % 4 = 0
              UNION ALL SELECT * REPLACE ('Brand#99' AS subcate_id) FROM one_cat WHERE CAST(item_id AS BIGINT) % 6 = 0""",
    "ost": """SELECT * FROM one_ost
              UNION ALL SELECT CAST(p_partkey + 2000000 AS VARCHAR), 0 FROM part WHERE p_partkey % 4 = 0""",
}


def with_fan(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``with_fixtures`` over the catalog and offer status with several rows per item."""
    return with_fixtures(body, *names, extra=extra, over=FAN_SQL)


def with_fixtures(body: str, *names: str, extra: dict[str, str] | None = None, over: dict[str, str] | None = None) -> str:
    """``WITH <fixtures and their dependencies>, <extra CTEs> <body>``.

    A fixture in ``over`` is defined by that SQL, which may read the plain one as ``one_<name>``.
    """
    order: list[str] = []

    def add(n: str) -> None:
        deps, _ = FIXTURE_SQL[n]
        for d in deps:
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = []
    for n in order:
        if n in (over or {}):
            ctes += [f"one_{n} AS ({FIXTURE_SQL[n][1]})", f"{n} AS ({over[n]})"]
        else:
            ctes.append(f"{n} AS ({FIXTURE_SQL[n][1]})")
    for k, v in (extra or {}).items():
        ctes.append(f"{k} AS ({v})")
    return "WITH " + ",\n".join(ctes) + "\n" + body
