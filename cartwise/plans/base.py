"""Shared inputs of the feature plans.

Inputs follow the retail data model:

* ``lines``    (order_id, product_id, add_to_cart_order, reordered)
* ``orders``   (order_id, user_id, order_number, order_dow, order_hour_of_day, ...)
* ``products`` (product_id, product_name, ...)

``line_facts`` attaches to every line its order's attributes and the basket
size. The basket size comes from a grouped count (partial aggregation, skew
safe) joined back on ``order_id``; the orders side is one row per order, so
AQE's skew-join split applies if one order is very large. Every user,
product and user×product feature is an aggregate over this one frame, which
replaces the pairwise self-join of order lines: for lines unique per
(order, product) the number of other products in the order is
``basket_size - 1``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

ORDER_ATTRS = ("user_id", "order_number", "order_dow", "order_hour_of_day")


def basket_sizes(lines: DataFrame) -> DataFrame:
    """(order_id, basket_size): number of lines with a product in each order."""
    return lines.groupBy("order_id").agg(F.count("product_id").alias("basket_size"))


def line_facts(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines ⟕ orders with the basket size of the line's order.

    Lines whose order is absent keep null order attributes (left join).
    """
    per_order = basket_sizes(lines).join(
        orders.select("order_id", *ORDER_ATTRS), "order_id", "left")
    return lines.join(per_order, "order_id", "left")


def cast_longs_to_double(df: DataFrame, keep: tuple[str, ...] = ("user_id", "product_id", "order_id")) -> DataFrame:
    """Cast every LongType field to double, driven by the schema (ids kept)."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields
                           if isinstance(f.dataType, LongType) and f.name not in keep})


def cast_strings_to_double(df: DataFrame) -> DataFrame:
    """Cast every StringType field to double (``try_cast``: bad text → null)."""
    return df.withColumns({f.name: F.col(f.name).try_cast("double") for f in df.schema.fields
                           if isinstance(f.dataType, StringType)})


@dataclass
class FeatureInput:
    """Lines and orders the features are computed over, plus products.

    ``facts`` is ``line_facts(lines, orders)``, built once and shared by all
    feature plans so that lines and orders are joined a single time.
    """
    lines: DataFrame
    orders: DataFrame
    products: DataFrame
    facts: DataFrame
    written: bool = False  # facts already read from a written table

    @classmethod
    def of(cls, lines: DataFrame, orders: DataFrame, products: DataFrame) -> "FeatureInput":
        return cls(lines, orders, products, line_facts(lines, orders))

    def materialize(self) -> "FeatureInput":
        """Write ``facts`` once (a parquet table in the shared checkpoint folder).

        Every feature family aggregates the same facts; without this each of
        them re-runs the lines ⋈ orders join. The written copy also cuts the
        lineage, so a lost executor re-reads it instead of recomputing.
        """
        if self.written:
            return self
        from cartwise.session import materialize
        return FeatureInput(self.lines, self.orders, self.products, materialize(self.facts, "line-facts"), True)


def split_inputs(orders: DataFrame, lines: DataFrame, products: DataFrame,
                 leak_free: bool = False, line_facts: DataFrame | None = None) -> FeatureInput:
    """Feature inputs from the full basket tables.

    ``leak_free=False`` (the analysed behaviour): orders with eval_set != 'test'
    and the lines of those orders (prior ∪ train lines); features are then
    computed over the same lines that carry the training label.
    ``leak_free=True``: prior orders and prior lines only; the train / test
    orders are held out as labels and prediction targets.
    ``line_facts``: the lines already carrying eval_set, basket size and the
    order attributes (``sources.views.LINE_FACT_COLUMNS``), as stored by the
    basket loader; then no join is needed.
    """
    keep = (F.col("eval_set") == "prior") if leak_free else (F.col("eval_set") != "test")
    o = orders.where(keep).drop("eval_set")
    if line_facts is not None:
        # lines stored with their order attributes (and partitioned by eval_set):
        # the split is a partition filter, no join
        facts = line_facts.where(keep).select(*lines.columns, "basket_size", *ORDER_ATTRS)
        return FeatureInput(facts.select(*lines.columns), o, products, facts, written=True)
    # inner join: keeps exactly the lines of the kept orders (one join, no semi-join pass)
    per_order = basket_sizes(lines).join(o.select("order_id", *ORDER_ATTRS), "order_id")
    facts = lines.join(per_order, "order_id")
    return FeatureInput(facts.select(*lines.columns), o, products, facts)
