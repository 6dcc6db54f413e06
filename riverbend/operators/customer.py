"""Customer weight report: customers LEFT JOIN orders LEFT JOIN products, SUM(weight).

A customer without orders keeps its row with a NULL sum; the order quantity
is not multiplied in (both as in the reference).

Plan: the weight is summed per purchaser *before* it meets the customers,
so the big side (orders / order lines) is reduced by a partial aggregate
and the customer table joins an already aggregated, purchaser-partitioned
result.  SUM over the left-joined rows and SUM of per-purchaser sums agree,
NULLs included (all-NULL gives NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purchaser_weights(orders: DataFrame, products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """``(purchaser, total_weight)``.

    ``orders(id, purchaser[, product_id])``; when ``lines(order_id,
    product_id)`` is given, products hang off order lines instead.
    ``products(id, weight)``.
    """
    prod = products.select(F.col("id").alias("_pid"), F.col("weight"))
    if lines is None:
        items = orders.select("purchaser", "product_id")
        weighted = items.join(prod, items["product_id"] == prod["_pid"], "left")
        return weighted.groupBy("purchaser").agg(F.sum("weight").alias("total_weight"))
    # weight per order first (partial aggregate next to the scan), then per purchaser
    ln = lines.select("order_id", "product_id")
    per_order = (ln.join(prod, ln["product_id"] == prod["_pid"], "left")
                   .groupBy("order_id").agg(F.sum("weight").alias("w")))
    o = orders.select("id", "purchaser")
    return (o.join(per_order, o["id"] == per_order["order_id"], "left")
             .groupBy("purchaser").agg(F.sum("w").alias("total_weight")))


def customer_weight(customers: DataFrame, orders: DataFrame, products: DataFrame,
                    lines: DataFrame | None = None, *, max_id: int | None = None,
                    load_ts: str | None = None, name_cols=("first_name", "last_name")) -> DataFrame:
    """``(id, *name_cols, total_weight, load_dttm)`` per customer.

    ``max_id`` is the reference's ``c.id <= N`` filter (pushed to the scan);
    ``load_ts`` fixes the load time (default: the current timestamp).
    """
    cust = customers.select("id", *name_cols)
    if max_id is not None:
        cust = cust.filter(F.col("id") <= F.lit(max_id))
        orders = orders.filter(F.col("purchaser") <= F.lit(max_id))
    weights = purchaser_weights(orders, products, lines)
    out = cust.join(weights, cust["id"] == weights["purchaser"], "left") \
              .select("id", *name_cols, "total_weight")
    stamp = F.current_timestamp() if load_ts is None else F.lit(load_ts).cast("timestamp_ntz")
    return out.withColumn("load_dttm", stamp)
