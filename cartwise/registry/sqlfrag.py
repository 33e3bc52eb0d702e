"""Oracle SQL fragments (DuckDB) for the feature family.

Written in the shape of the analysed code — self-joins for co-occurrence,
window functions for streaks, per-order pivots — so that the oracle checks
the Spark rewrites (basket-size arithmetic, single-pass aggregates) against
an independent formulation on the same basket views.
"""

from __future__ import annotations

from cartwise.sources.views import with_views

KW = ("red", "blue", "large")


def kw_pred(col: str) -> str:
    return "(" + " OR ".join(f"lower({col}) LIKE '%{k}%'" for k in KW) + ")"


# name -> (sql, dependencies, base views)
FRAG: dict[str, tuple[str, tuple[str, ...], tuple[str, ...]]] = {
    # faithful inputs: non-test orders and their lines
    "fo": ("SELECT * FROM orders_v WHERE eval_set <> 'test'", (), ("orders_v",)),
    "fl": ("SELECT l.* FROM order_products_v l JOIN fo ON l.order_id = fo.order_id", ("fo",), ("order_products_v",)),
    # leak-free inputs: prior orders and their lines
    "po": ("SELECT * FROM orders_v WHERE eval_set = 'prior'", (), ("orders_v",)),
    "pl": ("SELECT l.* FROM order_products_v l JOIN po ON l.order_id = po.order_id", ("po",), ("order_products_v",)),
    # ---- user features
    "uf_reord": ("""SELECT o.user_id, count(l.reordered) AS frequency_of_reorder
        FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id""", ("fl", "fo"), ()),
    "uf_kw": (f"""SELECT user_id, sum(f) AS count_of_asian_org_items, avg(f) AS mean_of_asian_org_items FROM (
          SELECT o.user_id, l.order_id,
                 CAST(coalesce(bool_or({kw_pred('p.product_name')}), false) AS INTEGER) AS f
          FROM fl l LEFT JOIN products_v p ON l.product_id = p.product_id
                    LEFT JOIN fo o ON l.order_id = o.order_id
          GROUP BY o.user_id, l.order_id) t GROUP BY user_id""", ("fl", "fo"), ("products_v",)),
    "uf_size": ("""SELECT user_id, max(c) AS max_count_of_products, min(c) AS min_count_of_products,
               avg(c) AS mean_count_of_products FROM (
          SELECT o.user_id, l.order_id, count(l.product_id) AS c
          FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id, l.order_id) t
        GROUP BY user_id""", ("fl", "fo"), ()),
    "uf_norep": ("""SELECT user_id, sum(d) AS count_ord_no_prev_purchased_items,
               avg(d) AS mean_ord_no_prev_purchased_items FROM (
          SELECT o.user_id, l.order_id, CASE WHEN bool_or(l.reordered = 1) THEN 0 ELSE 1 END AS d
          FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id, l.order_id) t
        GROUP BY user_id""", ("fl", "fo"), ()),
    "uf": ("""SELECT r.user_id,
          CAST(r.frequency_of_reorder AS DOUBLE) AS frequency_of_reorder,
          CAST(k.count_of_asian_org_items AS DOUBLE) AS count_of_asian_org_items,
          k.mean_of_asian_org_items,
          CAST(s.max_count_of_products AS DOUBLE) AS max_count_of_products,
          CAST(s.min_count_of_products AS DOUBLE) AS min_count_of_products,
          s.mean_count_of_products,
          CAST(n.count_ord_no_prev_purchased_items AS DOUBLE) AS count_ord_no_prev_purchased_items,
          n.mean_ord_no_prev_purchased_items
        FROM uf_reord r LEFT JOIN uf_kw k ON r.user_id = k.user_id
             LEFT JOIN uf_size s ON r.user_id = s.user_id
             LEFT JOIN uf_norep n ON r.user_id = n.user_id""", ("uf_reord", "uf_kw", "uf_size", "uf_norep"), ()),
    # ---- product features
    "pf_pos": ("""SELECT product_id, avg(add_to_cart_order) AS product_mean_of_position
        FROM fl GROUP BY product_id""", ("fl",), ()),
    "pf_one": ("""SELECT product_id, sum(has1) AS number_of_user_purchased_item FROM (
          SELECT x.product_id, o.user_id, max(x.one) AS has1 FROM (
            SELECT order_id, product_id,
                   CASE WHEN count(product_id) OVER (PARTITION BY order_id) = 1 THEN 1 ELSE 0 END AS one
            FROM fl WHERE product_id IS NOT NULL) x
          LEFT JOIN fo o ON x.order_id = o.order_id GROUP BY x.product_id, o.user_id) t
        GROUP BY product_id""", ("fl", "fo"), ()),
    "pairs": ("""SELECT a.order_id, a.product_id, b.product_id AS product_id_1
        FROM fl a LEFT JOIN fl b ON a.order_id = b.order_id AND a.product_id <> b.product_id""", ("fl",), ()),
    "pf_co": ("""SELECT product_id, count(product_id_1) AS number_of_product_co_occurred
        FROM pairs GROUP BY product_id""", ("pairs",), ()),
    "pf_costat": ("""SELECT product_id, avg(c) AS mean_of_co_ocuured_product_per_order,
               min(c) AS min_of_co_ocuured_product_per_order, max(c) AS max_of_co_ocuured_product_per_order
        FROM (SELECT product_id, order_id, count(product_id_1) AS c FROM pairs GROUP BY product_id, order_id) t
        GROUP BY product_id""", ("pairs",), ()),
    "seq": ("""SELECT l.product_id, o.user_id, o.order_number, l.order_id
        FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id""", ("fl", "fo"), ()),
    "flagged": ("""SELECT *, lead(order_number) OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS next_order_number,
          CASE WHEN lead(order_number) OVER (PARTITION BY user_id, product_id ORDER BY order_number) - order_number = 1
               THEN 1 ELSE 0 END AS is_streak_continued_flag
        FROM seq""", ("seq",), ()),
    "streaks": ("""SELECT user_id, product_id, grp, count(order_number) AS length_of_streaks FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number)
                  - row_number() OVER (PARTITION BY user_id, product_id, is_streak_continued_flag ORDER BY order_number) AS grp
          FROM flagged) t GROUP BY user_id, product_id, grp""", ("flagged",), ()),
    "islands": ("""SELECT user_id, product_id, grp, count(order_number) AS length_of_streaks FROM (
          SELECT *, order_number - row_number() OVER (PARTITION BY user_id, product_id ORDER BY order_number) AS grp
          FROM seq) t GROUP BY user_id, product_id, grp""", ("seq",), ()),
    "pf_streak": ("""SELECT product_id, count(grp) AS Total_streak_of_this_product,
          avg(length_of_streaks) AS mean_of_streaks_of_this_product,
          min(length_of_streaks) AS min_of_streaks_of_this_product,
          max(length_of_streaks) AS max_of_streaks_of_this_product,
          sum(CASE WHEN length_of_streaks >= 5 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_5,
          sum(CASE WHEN length_of_streaks >= 3 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_3,
          sum(CASE WHEN length_of_streaks >= 2 THEN 1 ELSE 0 END) / count(length_of_streaks) AS prob_of_reordered_2
        FROM streaks GROUP BY product_id""", ("streaks",), ()),
    "dow_pivot": ("SELECT order_id, " + ", ".join(
        f'coalesce(max(CASE WHEN order_dow = {d} THEN 1 END), 0) AS "{d}"' for d in range(7))
        + " FROM fo GROUP BY order_id", ("fo",), ()),
    "pf_dow": ("SELECT l.product_id, " + ", ".join(
        f'sum(p."{d}") AS distrib_count_of_dow_{d}_p_prod' for d in range(7))
        + " FROM fl l LEFT JOIN dow_pivot p ON l.order_id = p.order_id GROUP BY l.product_id",
        ("fl", "dow_pivot"), ()),
    "pf_sup": ("""SELECT product_id, sum(order_count) / (SELECT count(DISTINCT order_id) FROM fo) AS prob_of_being_reordered
        FROM (SELECT l.product_id, o.user_id, count(o.order_id) AS order_count
              FROM fo o LEFT JOIN fl l ON o.order_id = l.order_id GROUP BY l.product_id, o.user_id) t
        WHERE product_id IS NOT NULL GROUP BY product_id""", ("fo", "fl"), ()),
    "pf": ("""SELECT a.product_id, a.product_mean_of_position,
          CAST(b.number_of_user_purchased_item AS DOUBLE) AS number_of_user_purchased_item,
          CAST(c.number_of_product_co_occurred AS DOUBLE) AS number_of_product_co_occurred,
          d.mean_of_co_ocuured_product_per_order,
          CAST(d.min_of_co_ocuured_product_per_order AS DOUBLE) AS min_of_co_ocuured_product_per_order,
          CAST(d.max_of_co_ocuured_product_per_order AS DOUBLE) AS max_of_co_ocuured_product_per_order,
          CAST(e.Total_streak_of_this_product AS DOUBLE) AS Total_streak_of_this_product,
          e.mean_of_streaks_of_this_product,
          CAST(e.min_of_streaks_of_this_product AS DOUBLE) AS min_of_streaks_of_this_product,
          CAST(e.max_of_streaks_of_this_product AS DOUBLE) AS max_of_streaks_of_this_product,
          e.prob_of_reordered_5, e.prob_of_reordered_3, e.prob_of_reordered_2, """
           + ", ".join(f"CAST(f.distrib_count_of_dow_{d}_p_prod AS DOUBLE) AS distrib_count_of_dow_{d}_p_prod"
                       for d in range(7))
           + """, g.prob_of_being_reordered
        FROM pf_pos a LEFT JOIN pf_one b ON a.product_id = b.product_id
          LEFT JOIN pf_co c ON a.product_id = c.product_id
          LEFT JOIN pf_costat d ON a.product_id = d.product_id
          LEFT JOIN pf_streak e ON a.product_id = e.product_id
          LEFT JOIN pf_dow f ON a.product_id = f.product_id
          LEFT JOIN pf_sup g ON a.product_id = g.product_id""",
           ("pf_pos", "pf_one", "pf_co", "pf_costat", "pf_streak", "pf_dow", "pf_sup"), ()),
    # ---- user x product features
    "up_n": ("""SELECT o.user_id, l.product_id, count(l.order_id) AS num_of_ord_purch_p_prod
        FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id, l.product_id""", ("fl", "fo"), ()),
    "up_pos": ("""SELECT o.user_id, l.product_id, avg(l.add_to_cart_order) AS prod_mean_of_position_p_user
        FROM fl l LEFT JOIN fo o ON l.order_id = o.order_id GROUP BY o.user_id, l.product_id""", ("fl", "fo"), ()),
    "up_co": ("""SELECT o.user_id, p.product_id, count(p.product_id_1) AS num_of_prod_co_ocrd_p_usr_p_prod
        FROM pairs p LEFT JOIN fo o ON p.order_id = o.order_id GROUP BY o.user_id, p.product_id""", ("pairs", "fo"), ()),
    "upf": ("""SELECT n.user_id, n.product_id,
          CAST(n.num_of_ord_purch_p_prod AS DOUBLE) AS num_of_ord_purch_p_prod,
          p.prod_mean_of_position_p_user,
          CAST(c.num_of_prod_co_ocrd_p_usr_p_prod AS DOUBLE) AS num_of_prod_co_ocrd_p_usr_p_prod
        FROM up_n n LEFT JOIN up_pos p ON n.user_id = p.user_id AND n.product_id = p.product_id
          LEFT JOIN up_co c ON n.user_id = c.user_id AND n.product_id = c.product_id""",
            ("up_n", "up_pos", "up_co"), ()),
    # ---- time features
    "dow_counts": ("SELECT order_dow, count(order_id) AS total_ord_count_p_dow FROM fo GROUP BY order_dow", ("fo",), ()),
    "hour_counts": ("""SELECT order_hour_of_day, count(order_id) AS total_ord_count_p_ohod
        FROM fo GROUP BY order_hour_of_day""", ("fo",), ()),
    "tf": ("""SELECT o.user_id, o.order_id, o.order_dow AS dow, o.order_hour_of_day AS hour_of_day,
          CAST(d.total_ord_count_p_dow AS DOUBLE) AS total_ord_count_p_dow,
          CAST(h.total_ord_count_p_ohod AS DOUBLE) AS total_ord_count_p_ohod
        FROM fo o LEFT JOIN dow_counts d ON o.order_dow = d.order_dow
          LEFT JOIN hour_counts h ON o.order_hour_of_day = h.order_hour_of_day""",
           ("fo", "dow_counts", "hour_counts"), ()),
    "tconst": ("""SELECT (SELECT avg(total_ord_count_p_dow) FROM dow_counts) AS time_mean_dow_count,
               (SELECT avg(total_ord_count_p_ohod) FROM hour_counts) AS time_mean_ohod_count""",
               ("dow_counts", "hour_counts"), ()),
}



def _leak_free_variants() -> None:
    """Add ``<name>_lf`` fragments computed over prior orders / prior lines only."""
    import re

    base = [n for n in FRAG if n not in ("fo", "fl", "po", "pl")]
    ren = {"fo": "po", "fl": "pl", **{n: n + "_lf" for n in base}}
    pat = re.compile(r"\b(" + "|".join(sorted(ren, key=len, reverse=True)) + r")\b")
    for n in base:
        sql, deps, vs = FRAG[n]
        FRAG[n + "_lf"] = (pat.sub(lambda m: ren[m.group(1)], sql), tuple(ren.get(d, d) for d in deps), vs)


_leak_free_variants()

USER_COLS = ["frequency_of_reorder", "count_of_asian_org_items", "mean_of_asian_org_items",
             "max_count_of_products", "min_count_of_products", "mean_count_of_products",
             "count_ord_no_prev_purchased_items", "mean_ord_no_prev_purchased_items"]
PRODUCT_COLS = ["product_mean_of_position", "number_of_user_purchased_item", "number_of_product_co_occurred",
                "mean_of_co_ocuured_product_per_order", "min_of_co_ocuured_product_per_order",
                "max_of_co_ocuured_product_per_order", "Total_streak_of_this_product",
                "mean_of_streaks_of_this_product", "min_of_streaks_of_this_product",
                "max_of_streaks_of_this_product", "prob_of_reordered_5", "prob_of_reordered_3",
                "prob_of_reordered_2", *[f"distrib_count_of_dow_{d}_p_prod" for d in range(7)],
                "prob_of_being_reordered"]
UP_COLS = ["num_of_ord_purch_p_prod", "prod_mean_of_position_p_user", "num_of_prod_co_ocrd_p_usr_p_prod"]


def r6(cols, alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    return ", ".join(f"round({pre}{c}, 6) AS {c}" for c in cols)


def compose(body: str, *frags: str, views: tuple[str, ...] = ("orders_v", "order_products_v")) -> str:
    """WITH <base views>, <fragments in dependency order> <body>."""
    order: list[str] = []
    views = list(views)

    def visit(n: str) -> None:
        if n in order:
            return
        sql, deps, vs = FRAG[n]
        for d in deps:
            visit(d)
        views.extend(v for v in vs if v not in views)
        order.append(n)

    for f in frags:
        visit(f)
    if not order:
        return with_views(body, *views)
    ctes = ",\n".join(f"{n} AS ({FRAG[n][0]})" for n in order)
    return with_views(f"WITH {ctes}\n{body.strip()}", *views)
