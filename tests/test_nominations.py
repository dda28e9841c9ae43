"""Nominations pipeline on the four-product fixture, current week 202401."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillroll.plans import nominations as N
from tillroll.sources import schemas

WEEK = 202401


@pytest.fixture(scope="module")
def inputs(spark):
    prod = spark.createDataFrame([
        (WEEK, "P1", "Acme", "L1", "Tea", "p1"), (WEEK, "P2", "Acme", "L1", "Tea", "p2"),
        (WEEK, "P3", "Zed", "L1", "Tea", "p3"), (WEEK, "P4", "Acme", "L2", "Jam", "p4"),
    ], schemas.PROD)
    nom_prod = spark.createDataFrame([
        (WEEK, "AAA", "P1", "N1", WEEK), (WEEK, "BBB", "P3", "N1", WEEK),
        (WEEK, "AAA", None, "N1", WEEK), (202352, "AAA", "P4", "N1", 202352),
    ], schemas.NOMINATION_PROD)
    selected = spark.createDataFrame([("E1", 1, "N1", "S", WEEK, WEEK), ("E2", 1, "N2", "S", WEEK, WEEK)],
                                     schemas.SELECTED_NOMINATIONS)
    rerun = spark.createDataFrame([("E1", "true"), ("E2", "false")], schemas.RE_RUN_EVENTS)
    return nom_prod, prod, selected, rerun


@pytest.fixture(scope="module")
def steps(inputs):
    nom_prod, prod, selected, _ = inputs
    nominated = N.nominated_products(nom_prod, selected, WEEK, ["AAA"])
    li = N.line_item_products(nominated)
    master = N.product_master(prod)
    return nominated, li, master


def test_nominated(steps):
    nominated = steps[0]
    assert [(r.parent_event_code, r.line_item_id, r.seg_desc_list, r.prod_group_code)
            for r in nominated.collect()] == [("E1", 1, "S", "P1")]


def test_missing_week_raises(inputs):
    nom_prod, _, selected, _ = inputs
    with pytest.raises(ValueError):
        N.nominated_products(nom_prod, selected, None)


def test_final_products(steps):
    _, li, master = steps
    fp, br, ca = N.featured_products(li, master), N.brand_products(li, master), N.category_products(li, master)
    final = N.final_nomination_products(fp, br, ca)
    got = {r.prod_group_code: (r.fp, r.brand, r.cat) for r in final.collect()}
    assert got == {"P1": (True, True, True), "P2": (False, True, True), "P3": (False, False, True)}
    assert final.columns == N.FINAL_COLUMNS


def test_null_keys_match_nothing(spark):
    keys = "parent_event_code string, line_item_id int, seg_desc_list string, prod_group_code string, " \
           "nomination_start_week int"
    fp = spark.createDataFrame([("E", 1, None, "P", 1, "d", True)], keys + ", product_desc string, fp boolean")
    br = spark.createDataFrame([("E", 1, None, "P", 1, "b", True)], keys + ", brand_desc string, brand boolean")
    ca = spark.createDataFrame([("E", 1, "S", "P", 1, "c", True)], keys + ", cat_desc string, cat boolean")
    assert N.final_nomination_products(fp, br, ca).count() == 3


def test_every_description_and_brand_is_kept(spark):
    keys = "parent_event_code string, line_item_id int, seg_desc_list string, prod_group_code string, " \
           "nomination_start_week int"
    fp = spark.createDataFrame([("E", 1, "S", "P", 1, d, True) for d in ("d1", "d2")],
                               keys + ", product_desc string, fp boolean")
    br = spark.createDataFrame([("E", 1, "S", "Q", 1, b, True) for b in ("b1", "b2")],
                               keys + ", brand_desc string, brand boolean")
    ca = spark.createDataFrame([("E", 1, "S", p, 1, "c", True) for p in "PQ"], keys + ", cat_desc string, cat boolean")
    got = sorted((r.prod_group_code, r.product_desc or r.brand_desc) for r in
                 N.final_nomination_products(fp, br, ca).collect())
    assert got == [("P", "d1"), ("P", "d2"), ("Q", "b1"), ("Q", "b2")]


def test_dominant_brand_flags_and_lists(inputs, steps):
    _, _, selected, _ = inputs
    nominated, _, master = steps
    bc = N.event_brand_categories(nominated, master)
    dom = N.dominant_brand(bc)
    assert [tuple(r) for r in dom.collect()] == [("E1", "Acme", "Tea")]
    flagged = N.flag_nominations(selected, dom, nominated)
    got = {r.parent_event_code: (r.brand_name, r.category, r.prod_found_flag) for r in flagged.collect()}
    assert got == {"E1": ("Acme", "Tea", 1), "E2": (None, None, 0)}
    lists = N.brands_and_categories(selected, bc)
    got = {r.parent_event_code: (r.brands, r.categories, r.nomination_code) for r in lists.collect()}
    assert got == {"E1": ("Acme", "Tea", "N1"), "E2": ("", "", "N2")}


def test_dominant_brand_ties_and_counts(spark):
    bc = spark.createDataFrame([("E", "Zed", "L1", "a"), ("E", "Zed", "L2", "b"), ("E", "Acme", "L1", "c"),
                                ("F", "Zed", "L1", "a"), ("F", "Acme", "L2", "b")],
                               "parent_event_code string, brand_name string, prod_merch_l10_code string, "
                               "prod_merch_l10_desc string")
    got = sorted(tuple(r) for r in N.dominant_brand(bc).collect())
    assert got == [("E", "Zed", "a"), ("F", "Acme", "b")]


def test_line_item_survivor_is_earliest(spark):
    df = spark.createDataFrame([("N2", "P", "E", 1, "S", 5, 5), ("N1", "P", "E", 1, "S", 5, 5),
                                ("N0", "P", "E", 1, "S", 7, 1)],
                               "nomination_code string, prod_group_code string, parent_event_code string, "
                               "line_item_id int, seg_desc_list string, nomination_start_week int, "
                               "event_start_week int")
    out = N.line_item_products(df).collect()
    assert [(r.nomination_code, r.nomination_start_week) for r in out] == [("N1", 5)]


def test_rerun_only_on_the_configured_weekday(inputs, steps):
    _, _, selected, rerun = inputs
    monday = date(2024, 1, 1)
    assert "re_run" in N.with_rerun(selected, rerun, True, monday, 0).columns
    assert "re_run" not in N.with_rerun(selected, rerun, True, monday, 2).columns
    assert "re_run" not in N.with_rerun(selected, rerun, False, monday, 0).columns


def test_hook(inputs):
    selected = inputs[2]
    out = N.apply_hook(selected, lambda df: df.withColumn("x", F.lit(1)))
    assert "x" in out.columns
    assert N.apply_hook(selected, None) is selected
    with pytest.raises(ValueError):
        N.apply_hook(selected, lambda df: None)


def _mappings():
    return {
        "nomination_prod": {k: k for k in N.NOM_PROD_KEYS},
        "prod": {k: k for k in N.PROD_KEYS},
        "nomination": {"nomination_code": "nomination_code", "seg_desc_list": "seg_desc_list"},
        "event": {"parent_event_code": "parent_event_code"},
    }


def test_build_nominations_end_to_end(spark, inputs):
    nom_prod, prod, selected, rerun = inputs
    params = N.NominationParams(current_week=WEEK, re_run=True, re_run_day=0, current_date=date(2024, 1, 1),
                                tables={"final_nomination_prod_info": "nom_final_products"})
    final, noms, lists = N.build_nominations(nom_prod, prod, selected, _mappings(), params, rerun)
    assert final.count() == 3 and spark.catalog.tableExists("nom_final_products")
    got = {r.parent_event_code: (r.prod_found_flag, r.re_run) for r in noms.collect()}
    assert got == {"E1": (1, "true"), "E2": (0, "false")}
    assert {r.parent_event_code: r.brands for r in lists.collect()} == {"E1": "Acme", "E2": ""}


def test_build_nominations_with_physical_names(spark, inputs):
    nom_prod, prod, selected, _ = inputs
    renamed = prod.withColumnRenamed("brand_name", "BRAND")
    maps = _mappings()
    maps["prod"] = {**maps["prod"], "brand_name": "BRAND"}
    final, _, _ = N.build_nominations(nom_prod, renamed, selected, maps, N.NominationParams(current_week=WEEK))
    assert final.count() == 3


def test_stray_columns_do_not_override_a_mapping(inputs):
    """A physical column that happens to have a logical name is neither used nor carried."""
    nom_prod, prod, selected, _ = inputs
    maps = _mappings()
    maps["nomination"] = {**maps["nomination"], "nomination_code": "NOM"}
    renamed = selected.withColumnRenamed("nomination_code", "NOM").withColumn("nomination_code", F.lit("stray"))
    final, noms, _ = N.build_nominations(nom_prod, prod, renamed, maps, N.NominationParams(current_week=WEEK))
    assert final.count() == 3
    assert {r.nomination_code for r in noms.collect()} == {"N1", "N2"}


def test_build_computes_the_week_once(inputs):
    """The products come from stored rows: the plan reads no input any more."""
    nom_prod, prod, selected, _ = inputs
    final, noms, _ = N.build_nominations(nom_prod, prod, selected, _mappings(), N.NominationParams(current_week=WEEK, salts=4))
    plan = final._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 3 and "LocalRelation" not in plan
    assert "_salt" in noms._jdf.queryExecution().optimizedPlan().toString()


def test_build_nominations_errors(inputs):
    nom_prod, prod, selected, _ = inputs
    params = N.NominationParams(current_week=WEEK)
    with pytest.raises(RuntimeError):
        N.build_nominations(nom_prod, prod, selected, None, params)
    bad = _mappings()
    del bad["prod"]["brand_name"]
    with pytest.raises(KeyError):
        N.build_nominations(nom_prod, prod, selected, bad, params)
    with pytest.raises(ValueError):
        N.build_nominations(nom_prod, "not a frame", selected, _mappings(), params)


def test_fused_sets_equal_three_set_merge(steps):
    _, li, master = steps
    three = N.final_nomination_products(N.featured_products(li, master), N.brand_products(li, master),
                                        N.category_products(li, master))
    fused = N.nomination_product_sets(li, master)
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, three.collect()))


def test_fused_sets_keep_null_segment_rows_apart(spark):
    li = spark.createDataFrame([("E", 1, None, "P1", 1)],
                               "parent_event_code string, line_item_id int, seg_desc_list string, "
                               "prod_group_code string, nomination_start_week int")
    master = spark.createDataFrame([(1, "P1", "B", "L", "l", "d1"), (1, "P2", "B", "L", "l", "d2"),
                                    (1, "P3", None, "L", "l", "d3")], schemas.PROD)
    three = N.final_nomination_products(N.featured_products(li, master), N.brand_products(li, master),
                                        N.category_products(li, master))
    fused = N.nomination_product_sets(li, master)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, fused.collect()), key=key) == sorted(map(tuple, three.collect()), key=key)
    assert fused.count() == 6      # null segment: P1 fp, brand, cat rows; P2 brand, cat; P3 cat
