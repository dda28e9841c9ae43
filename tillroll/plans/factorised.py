"""The nomination product sets as a factorised relation.

Category rows are line items times the products of their L10 classes, so the
expanded sets grow with the product of the two.  Factorised, they are two
relations that grow with the sum: ``classes`` (week, L10 code -> products) and
``members`` (line item -> week, L10 code, brand).  Sizes and link counts are
computed from these; rows are multiplied out only where a caller asks for them
(``expand_brand``, ``expand_category``, ``expand_final``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.skew import tiled_join

ITEM = ["parent_event_code", "line_item_id", "seg_desc_list", "nomination_start_week"]
_WEEK, _L10, _BRAND = "nomination_start_week", "prod_merch_l10_code", "brand_name"


@dataclass(frozen=True)
class NominationClasses:
    """``featured``: N4's rows.  ``members``: ITEM + L10 code + brand of its nominated products, distinct.
    ``classes``: week, L10 code, product, brand, L10 description, distinct, of the classes with a member."""
    featured: DataFrame
    members: DataFrame
    classes: DataFrame


def factorise(attributes: DataFrame, featured: DataFrame, master: DataFrame) -> NominationClasses:
    """The two relations from the line items' master rows (``nominated_attributes``) and the prefixed master.

    A null L10 code or week belongs to no class."""
    members = (attributes.where(F.col("m_prod_merch_l10_code").isNotNull() & F.col(_WEEK).isNotNull())
               .select(*ITEM, F.col("m_prod_merch_l10_code").alias(_L10), F.col("m_brand_name").alias(_BRAND)).distinct())
    used = members.select(F.col(_WEEK).alias("u_week"), F.col(_L10).alias("u_l10")).distinct()
    classes = (master.join(used, (F.col("m_fis_week_id") == F.col("u_week")) & (F.col("m_prod_merch_l10_code") == F.col("u_l10")),
                           "left_semi")
               .select(F.col("m_fis_week_id").alias(_WEEK), F.col("m_prod_merch_l10_code").alias(_L10),
                       F.col("m_prod_group_code").alias("prod_group_code"), F.col("m_brand_name").alias("brand_desc"),
                       F.col("m_prod_merch_l10_desc").alias("cat_desc")).distinct())
    return NominationClasses(featured, members, classes)


# --------------------------------------------------------------------------- on demand
def reached(members: DataFrame, products: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """Distinct (ITEM, ``value``) rows that the members (ITEM, ``key``) reach through ``key``.

    Products are classed by all the classes that hold their value in a week, so
    each stands in one class of classes; a member belongs to those that name one of
    its classes.  Both relations are distinct before they meet, and so are the pairs."""
    shared = [k for k in key if k == _WEEK or k in value]
    rest = [k for k in key if k not in shared]
    at = products.groupBy(_WEEK, *value).agg(F.sort_array(F.collect_set(F.struct(*rest))).alias("at"))
    named = at.select(*shared, "at").distinct().withColumn("one", F.explode("at")).select(*shared, "at", "one.*")
    of = members.join(named, key).select(*ITEM, *[k for k in shared if k not in ITEM], "at").distinct()
    return tiled_join(of, at, [*shared, "at"]).select(*ITEM, *value)


def expansion(f: NominationClasses) -> DataFrame:
    """Members times the products of their classes: N6's rows, and whether a row is also one of N5's."""
    out = tiled_join(f.members.withColumnRenamed(_BRAND, "a_brand"), f.classes, [_WEEK, _L10])
    return out.select(*ITEM, "prod_group_code", "brand_desc", "cat_desc", F.coalesce(
        F.col("a_brand") == F.col("brand_desc"), F.lit(False)).alias("same_brand")).distinct()


def expand_brand(f: NominationClasses, rows: DataFrame | None = None) -> DataFrame:
    """N5's rows: members meet the products of their class that have their brand."""
    rows = expansion(f) if rows is None else rows
    return rows.where("same_brand").select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", "brand_desc",
                                           F.lit(True).alias("brand"), _WEEK).distinct()


def expand_category(f: NominationClasses, rows: DataFrame | None = None) -> DataFrame:
    """N6's rows: members meet all products of their class."""
    rows = expansion(f) if rows is None else rows
    return rows.select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", "cat_desc",
                       F.lit(True).alias("cat"), _WEEK).distinct()


def _single(f: NominationClasses) -> DataFrame:
    """Products (week, product) that stand in one row of the classes and have one description at most."""
    one = (f.classes.where(F.col("prod_group_code").isNotNull()).groupBy(_WEEK, "prod_group_code")
           .agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in (_L10, "brand_desc", "cat_desc")]))
    described = (f.featured.groupBy(_WEEK, "prod_group_code")
                 .agg(F.collect_set(F.struct("product_desc")).alias("descs")))
    return (one.where("n = 1").drop("n").join(described, [_WEEK, "prod_group_code"], "left")
            .where(F.coalesce(F.size("descs") <= 1, F.lit(True)))
            .withColumn("product_desc", F.col("descs").getItem(0)["product_desc"]).drop("descs"))


def _single_rows(f: NominationClasses, single: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """N7's rows of the ``single`` products for line items without a null: each pair of a class is one row.

    The line item's brands and its own products of the class travel with it, so the
    flags need no further join and no row has to be sorted out afterwards."""
    named = f.members.where(_KEYED).groupBy(*ITEM, _L10).agg(F.collect_set(_BRAND).alias("brands"))
    own = (f.featured.where(_KEYED).join(single.select(_WEEK, "prod_group_code", _L10), [_WEEK, "prod_group_code"])
           .groupBy(*ITEM, _L10).agg(F.collect_set("prod_group_code").alias("own")))
    pairs = tiled_join(named.join(own, [*ITEM, _L10], "left"), single, [_WEEK, _L10], store=store)
    fp = F.coalesce(F.array_contains("own", F.col("prod_group_code")), F.lit(False))
    brand = F.coalesce(F.array_contains("brands", F.col("brand_desc")), F.lit(False))
    return (pairs.withColumn("fp", fp).withColumn("brand", brand)
            .select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", _WEEK,
                    F.when(F.col("fp"), F.col("product_desc")).alias("product_desc"), "fp",
                    F.when(F.col("brand"), F.col("brand_desc")).alias("brand_desc"), "brand", "cat_desc",
                    F.lit(True).alias("cat")))


_KEYED = " AND ".join(f"{c} IS NOT NULL" for c in ITEM)


def expand_final(f: NominationClasses, rows: DataFrame | None = None,
                 store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """N7's rows; ``rows`` is a stored ``expansion``, ``store`` a checkpoint for what several steps read.

    Without one, the pairs of line items and products that stand in one row of the
    classes are written as they are joined.  The rest (products with several rows,
    a null in a key) are few beside them and go through the three sets and their
    outer joins, as do nominated products that no class holds."""
    from tillroll.plans.nominations import final_nomination_products

    if rows is not None:
        return final_nomination_products(f.featured, expand_brand(f, rows), expand_category(f, rows))
    f = NominationClasses(f.featured, store(f.members), store(f.classes))
    single = store(_single(f))
    products = single.select(_WEEK, "prod_group_code")
    same = (F.col(f"c.{_WEEK}") == F.col(f"s.{_WEEK}")) & (F.col("c.prod_group_code") == F.col("s.prod_group_code"))
    others = f.classes.alias("c").join(products.alias("s"), same, "left_anti")
    featured = f.featured.where(f"NOT ({_KEYED})").union(
        f.featured.where(_KEYED).alias("c").join(products.alias("s"), same, "left_anti"))
    odd = NominationClasses(featured, f.members.where(_KEYED), others)
    null = NominationClasses(featured, f.members.where(f"NOT ({_KEYED})"), f.classes)
    rest = expansion(odd).union(expansion(null))
    plain = _single_rows(f, single, store)
    return plain.union(store(expand_final(odd, rest).select(*plain.columns)))


# --------------------------------------------------------------------------- link counts, unexpanded
def class_rows(f: NominationClasses) -> DataFrame:
    """One row per class and product, with the line items that reach it by category and by brand."""
    by_class = f.members.select(*ITEM, _L10).distinct().groupBy(_WEEK, _L10).agg(F.count(F.lit(1)).alias("n_line_items"))
    by_brand = (f.members.where(F.col(_BRAND).isNotNull()).groupBy(_WEEK, _L10, F.col(_BRAND).alias("brand_desc"))
                .agg(F.count(F.lit(1)).alias("n_brand_line_items")))
    return (f.classes.join(by_class, [_WEEK, _L10]).join(by_brand, [_WEEK, _L10, "brand_desc"], "left")
            .select(_WEEK, _L10, "prod_group_code", "brand_desc", "cat_desc", "n_line_items",
                    F.coalesce("n_brand_line_items", F.lit(0)).cast("long").alias("n_brand_line_items")))


def _linked(members: DataFrame, classes: DataFrame, key: list[str], value: list[str], name: str) -> DataFrame:
    """Distinct ``value`` rows that each line item reaches through the classes ``key``.

    The sum of the class sizes, less what several of an item's classes share:
    only values that stand in more than one class of a week meet the members."""
    classes = classes.select(*key, *value).distinct()
    sizes = classes.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    total = members.join(sizes, key).groupBy(*ITEM).agg(F.sum("size").alias("total"))
    shared = classes.groupBy(_WEEK, *value).agg(F.collect_list(F.struct(*key)).alias("at"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("n > 1").select(F.struct(*value).alias("value"), F.explode("at").alias("at")).select("value", "at.*")
    twice = (members.join(shared, key).groupBy(*ITEM, "value").agg((F.count(F.lit(1)) - 1).alias("more"))
             .groupBy(*ITEM).agg(F.sum("more").alias("more")))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ITEM]
    on = same[0] & same[1] & same[2] & same[3]
    return total.alias("t").join(twice.alias("w"), on, "left").select(
        *[F.col(f"t.{c}").alias(c) for c in ITEM], (F.col("total") - F.coalesce("more", F.lit(0))).alias(name))


def item_links(f: NominationClasses) -> DataFrame:
    """Per line item with a class the rows it has in N5 and N6, without building them."""
    category = _linked(f.members.drop(_BRAND).distinct(), f.classes, [_WEEK, _L10], ["prod_group_code", "cat_desc"],
                       "n_category")
    named = f.members.where(F.col(_BRAND).isNotNull())
    brand = _linked(named, f.classes.where(F.col("brand_desc").isNotNull()).withColumnRenamed("brand_desc", _BRAND),
                    [_WEEK, _L10, _BRAND], ["prod_group_code", _BRAND], "n_brand")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ITEM]
    on = same[0] & same[1] & same[2] & same[3]
    return category.alias("c").join(brand.alias("b"), on, "left").select(
        *[F.col(f"c.{c}").alias(c) for c in ITEM], "n_category", F.coalesce("n_brand", F.lit(0)).cast("long").alias("n_brand"))


def total_links(f: NominationClasses) -> DataFrame:
    """Per class: products, line items, and the category links between them (their product)."""
    products = f.classes.groupBy(_WEEK, _L10).agg(F.countDistinct(F.struct("prod_group_code", "cat_desc")).alias("n_products"))
    items = f.members.select(*ITEM, _L10).distinct().groupBy(_WEEK, _L10).agg(F.count(F.lit(1)).alias("n_line_items"))
    return products.join(items, [_WEEK, _L10]).select(
        _WEEK, _L10, "n_products", "n_line_items", (F.col("n_products") * F.col("n_line_items")).alias("n_links"))
