from riverbend.operators.customer import customer_weight


def test_customer_without_orders_keeps_null(spark):
    customers = spark.createDataFrame([(1, "A", "X"), (2, "B", "Y")],
                                      "id long, first_name string, last_name string")
    orders = spark.createDataFrame([(10, 2, 7)], "id long, purchaser long, product_id long")
    products = spark.createDataFrame([(7, 5.0)], "id long, weight double")
    rows = customer_weight(customers, orders, products, load_ts="2024-01-01 00:00:00").collect()
    got = sorted((r["id"], r["total_weight"]) for r in rows)
    assert got == [(1, None), (2, 5.0)]
    assert str(rows[0]["load_dttm"]) == "2024-01-01 00:00:00"


def test_id_bound_and_quantity_not_multiplied(spark):
    customers = spark.createDataFrame([(1000, "A", "X"), (1006, "B", "Y")],
                                      "id long, first_name string, last_name string")
    orders = spark.createDataFrame([(1, 1000, 7), (2, 1000, 7), (3, 1006, 7)],
                                   "id long, purchaser long, product_id long")
    products = spark.createDataFrame([(7, 2.5)], "id long, weight double")
    rows = customer_weight(customers, orders, products, max_id=1005).collect()
    assert [(r["id"], r["total_weight"]) for r in rows] == [(1000, 5.0)]
