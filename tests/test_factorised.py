"""The factorised nomination sets: link counts without expansion, expansion equal to the plain sets."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tillroll.plans import factorised as FA
from tillroll.plans import nominations as N

ITEMS = ("parent_event_code string, line_item_id int, seg_desc_list string, prod_group_code string, "
         "nomination_start_week int")
MASTER = ("prod_group_code string, brand_name string, prod_merch_l10_code string, prod_merch_l10_desc string, "
          "fis_week_id int, prod_desc string")


def inputs(spark, seed):
    """Products with several brands, codes and descriptions, nulls in every column, items without a master row."""
    r = random.Random(seed)
    products = ["p%d" % i for i in range(8)]
    master = {(r.choice(products + [None]), r.choice(["A", "B", None]), r.choice(["L1", "L2", "L3", None]),
               r.choice(["tea", "jam", None]), r.choice([1, 2, None]), r.choice(["x", "y", None])) for _ in range(40)}
    items = {(r.choice(["E1", "E2", None]), r.randint(1, 4), r.choice(["S", None]), r.choice(products + ["p9"]),
              r.choice([1, 2, 3])) for _ in range(25)}
    return (spark.createDataFrame(sorted(items, key=str), ITEMS), spark.createDataFrame(sorted(master, key=str), MASTER))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_expansion_and_link_counts_equal_the_plain_sets(spark, seed):
    items, master = inputs(spark, seed)
    fp, br, ca = N.featured_products(items, master), N.brand_products(items, master), N.category_products(items, master)
    f = N.nomination_classes(items, master)
    keys = N.FINAL_COLUMNS
    assert rows(FA.expand_final(f), *keys) == rows(N.final_nomination_products(fp, br, ca), *keys)
    assert rows(N.nomination_product_sets(items, master), *keys) == rows(FA.expand_final(f), *keys)
    counted = {tuple(r[c] for c in FA.ITEM): (r.n_category, r.n_brand) for r in FA.item_links(f).collect()}
    want = {}
    for k, df in enumerate((ca, br)):
        for r in df.collect():
            want.setdefault(tuple(r[c] for c in FA.ITEM), [0, 0])[k] += 1
    assert counted == {k: tuple(v) for k, v in want.items()}


def test_classes_grow_with_the_sum_not_the_product(spark):
    n, m = 60, 50
    items = spark.createDataFrame([("E", i, "S", "p0", 1) for i in range(n)], ITEMS)
    master = spark.createDataFrame([(f"p{j}", "A" if j % 2 else "B", "L", "tea", 1, f"d{j}") for j in range(m)], MASTER)
    f = N.nomination_classes(items, master)
    assert f.members.count() + f.classes.count() == n + m
    assert FA.expand_category(f).count() == n * m
    (total,) = FA.total_links(f).collect()
    assert (total.n_products, total.n_line_items, total.n_links) == (m, n, n * m)
    assert {(r.n_line_items, r.n_brand_line_items) for r in FA.class_rows(f).collect()} == {(n, n), (n, 0)}


def test_shared_products_of_two_classes_count_once(spark):
    items = spark.createDataFrame([("E", 1, "S", "a", 1), ("E", 1, "S", "b", 1)], ITEMS)
    master = spark.createDataFrame([("a", "A", "L1", "tea", 1, "d"), ("b", "A", "L2", "tea", 1, "d"),
                                    ("c", "A", "L1", "tea", 1, "d"), ("c", "A", "L2", "tea", 1, "d")], MASTER)
    f = N.nomination_classes(items, master)
    (r,) = FA.item_links(f).collect()
    assert (r.n_category, r.n_brand) == (3, 3) == (FA.expand_category(f).count(), FA.expand_brand(f).count())


def test_empty_inputs(spark):
    items, master = inputs(spark, 0)
    for a, b in itertools.product((items, items.where("false")), (master, master.where("false"))):
        f = N.nomination_classes(a, b)
        assert FA.expand_final(f).count() == N.final_nomination_products(
            N.featured_products(a, b), N.brand_products(a, b), N.category_products(a, b)).count()


def test_salted_attributes_equal_the_plain_ones(spark):
    items = spark.range(900).select(F.lit("E").alias("parent_event_code"), F.col("id").cast("int").alias("line_item_id"),
                                    F.lit("S").alias("seg_desc_list"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id"))).alias(
                                        "prod_group_code"), F.lit(1).alias("nomination_start_week"))
    master = spark.createDataFrame([(p, "A", "L", "tea", 1, d) for p, d in [("hot", "x"), ("hot", "y"), ("p1", "z")]], MASTER)
    plain, salted = N.nominated_attributes(items, master), N.nominated_attributes(items, master, salts=8)
    columns = ["line_item_id", "m_prod_desc", "m_prod_group_code", "m_fis_week_id"]
    assert rows(plain, *columns) == rows(salted, *columns) and plain.count() == 601


def test_pairs_of_one_class_are_spread_and_not_sorted_out_again(spark):
    """Line items times products of one L10 code: the pairs are dealt to the tasks and pass no aggregate."""
    n, m = 300, 400
    items = spark.range(n).select(F.lit("E").alias("parent_event_code"), F.col("id").cast("int").alias("line_item_id"),
                                  F.lit("S").alias("seg_desc_list"), F.concat(F.lit("p"), F.col("id")).alias("prod_group_code"),
                                  F.lit(1).alias("nomination_start_week"))
    master = spark.range(m).select(F.concat(F.lit("p"), F.col("id")).alias("prod_group_code"), F.lit("A").alias("brand_name"),
                                   F.lit("L").alias("prod_merch_l10_code"), F.lit("tea").alias("prod_merch_l10_desc"),
                                   F.lit(1).alias("fis_week_id"), F.concat(F.lit("d"), F.col("id")).alias("prod_desc"))
    for df in (N.category_products(items, master), N.brand_products(items, master), N.nomination_product_sets(items, master)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = next(i for i, line in enumerate(plan.splitlines()) if "Join Inner" in line and "_left" in line)
        assert not any("Aggregate" in line for line in plan.splitlines()[:join])
        assert df.count() == n * m == df.distinct().count()
    final = N.nomination_product_sets(items, master)
    assert (final.where("fp").count(), final.where("brand").count()) == (n, n * m)


def test_tiles_give_the_plain_join(spark):
    from tillroll.operators.skew import tiled_join
    r = random.Random(1)
    left = spark.createDataFrame([(r.choice(["a", "b", None]), r.randint(0, 40)) for _ in range(90)], "k string, x int")
    right = spark.createDataFrame([(r.choice(["a", "c", None, "b"]), r.choice([None, 1, 2, 3])) for _ in range(70)], "k string, y int")
    for groups in (None, 1, 7):
        assert rows(tiled_join(left, right, ["k"], groups)) == rows(left.join(right, "k"))
