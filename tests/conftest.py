from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from cartloom.sources.schema import SCHEMAS, Tables


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("cartloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# order_id, user_id, eval_set, order_number, dow, hour, gap
ORDERS = [
    (1, 1, "prior", 1, 0, 8, None),
    (2, 1, "prior", 2, 0, 9, 0.0),  # a second order on the same day
    (3, 1, "prior", 3, 3, 9, 7.0),
    (4, 1, "train", 4, 3, 10, 5.0),
    (5, 2, "prior", 1, 6, 23, None),  # one prior order with one line
    (6, 2, "train", 2, 6, 0, 30.0),
    (7, 3, "prior", 1, 2, 12, None),
    (8, 3, "test", 2, 2, 12, 3.0),
    (9, 4, "prior", 1, 1, 1, None),  # an order without lines
]
# order_id, product_id, add_to_cart_order, reordered
PRIOR = [
    (1, 10, 1, 0), (1, 11, 2, 0), (1, 12, 3, 0),
    (2, 10, 1, 1), (2, 12, 2, 1),
    (3, 10, 1, 1), (3, 13, 2, 0),
    (5, 11, 1, 0),
    (7, 10, 1, 0), (7, 11, 2, 0),
]
TRAIN = [
    (4, 10, 1, 1), (4, 14, 2, 0),  # product 14 was never bought before
    (6, 12, 1, 0),
]
PRODUCTS = [
    (10, "Organic Milk", 1, 100),
    (11, "ORGANIC bread", 2, 101),
    (12, "Plain, \"fresh\" apple", 3, 102),
    (13, "Soap", 4, 103),
    (14, "Two\nlines", 4, 103),
]
AISLES = [(1, "milk"), (2, "bread"), (3, "fruit"), (4, "bath")]
DEPARTMENTS = [(100, "dairy eggs"), (101, "bakery"), (102, "produce"), (103, "household")]


def make_tables(spark, orders=ORDERS, prior=PRIOR, train=TRAIN, products=PRODUCTS) -> Tables:
    def table(name, rows):
        return spark.createDataFrame(rows, SCHEMAS[name])

    op_prior, op_train = table("op_prior", prior), table("op_train", train)
    return Tables(
        orders=table("orders", orders),
        op_prior=op_prior,
        op_train=op_train,
        op_all=op_prior.unionByName(op_train),
        products=table("products", products),
        aisles=table("aisles", AISLES),
        departments=table("departments", DEPARTMENTS),
    )


@pytest.fixture(scope="session")
def shop(spark) -> Tables:
    return make_tables(spark)


def as_dicts(df) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
