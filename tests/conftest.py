import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cartwise.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=8, app_name="cartwise-tests", driver_memory="4g")
    yield s
    s.stop()


def make_orders(spark, rows):
    """rows: (order_id, user_id, order_number, order_dow, order_hour_of_day[, eval_set])"""
    rows = [r if len(r) == 6 else (*r, "prior") for r in rows]
    return spark.createDataFrame(
        rows, "order_id long, user_id long, order_number int, order_dow int, order_hour_of_day int, eval_set string")


def make_lines(spark, rows):
    """rows: (order_id, product_id, add_to_cart_order, reordered)"""
    return spark.createDataFrame(rows, "order_id long, product_id long, add_to_cart_order int, reordered int")


def make_products(spark, rows):
    return spark.createDataFrame(rows, "product_id long, product_name string")
