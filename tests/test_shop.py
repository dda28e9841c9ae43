"""Shop colour queries on the 20-customer / 20-product / 40-line fixture."""

import pytest

from tillroll.plans import shop as S

# The shop fixture (products; order lines follow the rule below).
PRODUCTS = [
    (1, "Laptop", "Silver"), (2, "Phone", "Black"), (3, "Headphones", "White"), (4, "Monitor", "Black"),
    (5, "Keyboard", "Gray"), (6, "Mouse", "Blue"), (7, "Printer", "White"), (8, "Speaker", "Red"),
    (9, "Camera", "Black"), (10, "Headphones", "Green"), (11, "Charger", "White"), (12, "Router", "Black"),
    (13, "SSD", "Silver"), (14, "USB Drive", "Blue"), (15, "Webcam", "Black"), (16, "Microphone", "Gray"),
    (17, "Smartwatch", "Gold"), (18, "Drone", "White"), (19, "Headphones", "Black"),
    (20, "VR Headset", "Black"),
]
# order i has product i and product i+4 (wrapping to 1..4 for orders 17..20); order 1 buys 2 keyboards
LINES = [(o, p, 2 if (o, p) == (1, 5) else 1)
         for o in range(1, 21) for p in (o, o + 4 if o <= 16 else o - 16)]


@pytest.fixture(scope="module")
def shop(spark):
    products = spark.createDataFrame(PRODUCTS, "id int, itemname string, item_colour string")
    lines = spark.createDataFrame(LINES, "order_id int, product_id int, quantity int")
    orders = spark.createDataFrame([(i, i, 100.0) for i in range(1, 21)],
                                   "id int, customer_id int, total_price double")
    return orders, lines, products


def test_units_by_colour(shop):
    _, lines, products = shop
    got = dict((r.item_colour, r.total_sold) for r in S.units_by_attr(lines, products).collect())
    assert got == {"Black": 14, "White": 8, "Gray": 5, "Silver": 4, "Blue": 4, "Red": 2, "Green": 2,
                   "Gold": 2}
    assert sum(got.values()) == 41


def test_most_sold_colour(shop):
    _, lines, products = shop
    assert [tuple(r) for r in S.top_attr(lines, products).collect()] == [("Black", 14)]


def test_distinct_headphone_buyers(shop):
    orders, lines, products = shop
    # Headphones are products 3, 10 and 19: orders 3, 19 / 6, 10 / 15, 19 -> customers 3, 6, 10, 15, 19
    assert S.distinct_buyers(orders, lines, products, "Headphones").collect()[0][0] == 5
