"""Weekly promotion nominations -> featured / brand / category products.

Canonical inputs (``canonicalize`` maps physical names onto these once):

* nomination_prod(fis_week_id, event_type_code, prod_level_code, nomination_code, event_start_week)
* prod(fis_week_id, prod_group_code, brand_name, prod_merch_l10_code, prod_merch_l10_desc, prod_desc)
* selected(parent_event_code, line_item_id, nomination_code, seg_desc_list,
           nomination_start_week, event_start_week, ...)
* re_run_events(parent_event_code, re_run)

No join is hinted: AQE chooses broadcast or sort-merge from the measured sizes.  The product sets (N4-N6) each start from the join of the line
items with their master rows (``nominated_attributes``); the fused form
(``nomination_product_sets``) derives all three from that join and one
expansion.  The master is always restricted to the weeks the line items
reference before it is joined (``in_weeks_of``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.canonical import canonicalize, check_frame, check_mapping
from tillroll.operators.relational import best_per_group, first_per_group, left_join, sorted_distinct_text
from tillroll.operators.skew import salted_join
from tillroll.plans import factorised
from tillroll.sources.catalog import checkpoint, materialize

NOM_PROD_KEYS = ("fis_week_id", "event_type_code", "prod_level_code", "nomination_code",
                 "event_start_week")
PROD_KEYS = ("prod_group_code", "brand_name", "prod_merch_l10_code", "prod_merch_l10_desc",
             "fis_week_id", "prod_desc")
NOMINATION_KEYS = ("nomination_code", "seg_desc_list")
EVENT_KEYS = ("parent_event_code",)
SELECTED_KEYS = ("parent_event_code", "line_item_id", "nomination_code", "seg_desc_list",
                 "nomination_start_week", "event_start_week")

LINE_KEYS = ["parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code"]
SET_KEYS = ["parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code",
            "nomination_start_week"]
FINAL_COLUMNS = SET_KEYS + ["product_desc", "fp", "brand_desc", "brand", "cat_desc", "cat"]


def in_weeks_of(frame: DataFrame, week_col: str, of: str = "fis_week_id"):
    """Condition: the week ``of`` is one that ``frame`` references.

    The weeks are a scalar subquery (a set of Mondays, so bounded by the calendar),
    evaluated once when the query runs: nothing runs while the plan is built.
    Unlike a join it is a plain filter, which Catalyst moves below aggregates and
    joins; on a table stored by week it prunes partitions when the scan starts."""
    return F.array_contains(frame.agg(F.collect_set(week_col).alias("weeks")).scalar(), F.col(of))


def _master_cols(m: DataFrame, weeks_from: DataFrame | None = None, week_col: str = "") -> DataFrame:
    """The master with prefixed names, so join keys are never ambiguous; with
    ``weeks_from`` restricted to the weeks which that frame references."""
    if weeks_from is not None:
        m = m.where(in_weeks_of(weeks_from, week_col))
    return m.select(*[F.col(c).alias(f"m_{c}") for c in PROD_KEYS])


# --------------------------------------------------------------------------- N1 .. N3
def nominated_products(nom_prod: DataFrame, selected: DataFrame, week,
                       event_types: Sequence[str] = ("AAA",)) -> DataFrame:
    """Nomination products of ``week`` with an allowed event type and a product
    level, joined to the selected nominations; the product level becomes the
    product group.  A missing week raises (it would silently match nothing)."""
    if week is None:
        raise ValueError("current week is not set")
    f = (nom_prod.where((F.col("fis_week_id") == F.lit(week))
                        & F.col("event_type_code").isin(list(event_types))
                        & F.col("prod_level_code").isNotNull())
         .select(F.col("prod_level_code").alias("prod_group_code"), "nomination_code"))
    s = selected.select("parent_event_code", "line_item_id", "seg_desc_list",
                        "nomination_start_week", "event_start_week", "nomination_code")
    return f.join(s, "nomination_code")


def line_item_products(nominated: DataFrame) -> DataFrame:
    """One row per (parent event, line item, segment, product group); the
    survivor is the earliest nomination week, then event week, then code.

    The smallest struct of a group is a sort-based aggregate: tasks sort their
    rows (spilling where needed) before the partial step."""
    return first_per_group(nominated, LINE_KEYS,
                           ["nomination_start_week", "event_start_week", "nomination_code"])


def product_master(prod: DataFrame) -> DataFrame:
    return prod.select(*PROD_KEYS).distinct()


# --------------------------------------------------------------------------- N4 .. N6
def nominated_attributes(line_items: DataFrame, master: DataFrame, salts: int | None = None) -> DataFrame:
    """Line items with their product's master row at the nomination week.

    ``salts`` spreads a product that very many line items nominate in a week
    over that many tasks (measured, see ``operators.skew``)."""
    m = _master_cols(master, line_items, "nomination_start_week")
    if salts:
        m = m.withColumn("nomination_start_week", F.col("m_fis_week_id")).withColumn("prod_group_code", F.col("m_prod_group_code"))
        return salted_join(line_items, m, ["nomination_start_week", "prod_group_code"], "inner", salts=salts)
    return line_items.join(m, (F.col("m_fis_week_id") == F.col("nomination_start_week"))
                           & (F.col("m_prod_group_code") == F.col("prod_group_code")))


def featured_of(attributes: DataFrame) -> DataFrame:
    """N4 from the line items' master rows."""
    return (attributes.select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code",
                              F.col("m_prod_desc").alias("product_desc"), F.lit(True).alias("fp"),
                              "nomination_start_week")
            .distinct())


def featured_products(line_items: DataFrame, master: DataFrame) -> DataFrame:
    return featured_of(nominated_attributes(line_items, master))


def _master_classes(master: DataFrame, line_items: DataFrame, *cols: str) -> DataFrame:
    """Columns of the master's rows that have an L10 code, in the weeks of the line items."""
    m = _master_cols(master, line_items, "nomination_start_week")
    return m.where(F.col("m_prod_merch_l10_code").isNotNull()).select(
        F.col("m_fis_week_id").alias("nomination_start_week"), "m_prod_merch_l10_code", *cols)


def brand_products(line_items: DataFrame, master: DataFrame) -> DataFrame:
    """Every product of the week sharing brand AND L10 code with a nominated
    product (NULL brand or code matches nothing).

    As large as line items times the products of their brands in an L10 code and
    week; the pairs are spread over the tasks (see ``factorised.reached``)."""
    a = (nominated_attributes(line_items, master)
         .select(*factorised.ITEM, "m_prod_merch_l10_code", F.col("m_brand_name").alias("brand_desc"))
         .distinct())
    m = _master_classes(master, line_items, F.col("m_prod_group_code").alias("prod_group_code"),
                        F.col("m_brand_name").alias("brand_desc")).where(F.col("brand_desc").isNotNull())
    j = factorised.reached(a, m, ["nomination_start_week", "m_prod_merch_l10_code", "brand_desc"],
                           ["prod_group_code", "brand_desc"])
    return j.select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", "brand_desc",
                    F.lit(True).alias("brand"), "nomination_start_week")


def category_products(line_items: DataFrame, master: DataFrame) -> DataFrame:
    """Every product of the week sharing the L10 code of a nominated product.

    That is the operator's definition, so the output is as large as line items
    times the products of their L10 codes in a week; the pairs are spread over the
    tasks (see ``factorised.reached``)."""
    a = (nominated_attributes(line_items, master).select(*factorised.ITEM, "m_prod_merch_l10_code").distinct())
    m = _master_classes(master, line_items, F.col("m_prod_group_code").alias("prod_group_code"),
                        F.col("m_prod_merch_l10_desc").alias("cat_desc"))
    j = factorised.reached(a, m, ["nomination_start_week", "m_prod_merch_l10_code"], ["prod_group_code", "cat_desc"])
    return j.select("parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", "cat_desc",
                    F.lit(True).alias("cat"), "nomination_start_week")


# --------------------------------------------------------------------------- N7
def final_nomination_products(featured: DataFrame, brand: DataFrame, category: DataFrame) -> DataFrame:
    """Featured, brand and category sets joined on the five keys, nothing left out.

    Two full outer joins: a key with several descriptions or brands keeps every
    combination, a NULL in a key matches nothing, and flags absent from a set are
    false."""
    j = featured.join(brand, SET_KEYS, "full_outer").join(category, SET_KEYS, "full_outer")
    no = F.lit(False)
    return j.select(*SET_KEYS, "product_desc", F.coalesce("fp", no).alias("fp"), "brand_desc",
                    F.coalesce("brand", no).alias("brand"), "cat_desc", F.coalesce("cat", no).alias("cat"))


def nomination_classes(line_items: DataFrame, master: DataFrame, salts: int | None = None) -> factorised.NominationClasses:
    """N4-N6 in factorised form (see ``plans.factorised``): as large as line items plus products.

    All three relations start from the line items' master rows, which are stored
    first (a reliable checkpoint)."""
    attrs = checkpoint(nominated_attributes(line_items, master, salts).select(
        "parent_event_code", "line_item_id", "seg_desc_list", "prod_group_code", "nomination_start_week",
        "m_prod_desc", "m_brand_name", "m_prod_merch_l10_code"))
    return factorised.factorise(attrs, featured_of(attrs), _master_cols(master, attrs, "nomination_start_week"))


def nomination_product_sets(line_items: DataFrame, master: DataFrame) -> DataFrame:
    """N4-N7 fused: the same result as
    ``final_nomination_products(featured_products(..), brand_products(..), category_products(..))``
    from two joins with the master instead of five.  The relations of the factorised
    form are stored (reliable checkpoints), since several steps read them; they are
    multiplied out when the result is read, and not stored in that form."""
    return factorised.expand_final(nomination_classes(line_items, master), store=checkpoint)


# --------------------------------------------------------------------------- N8, N9, N11, N12
def event_brand_categories(nominated: DataFrame, master: DataFrame) -> DataFrame:
    """Distinct (parent event, brand, L10 code, L10 desc) of the nominated
    products, looked up at the event start week."""
    ev = nominated.select("parent_event_code", "prod_group_code", "event_start_week").distinct()
    m = _master_cols(master, ev, "event_start_week")
    j = ev.join(m, (F.col("m_fis_week_id") == F.col("event_start_week"))
                & (F.col("m_prod_group_code") == F.col("prod_group_code")))
    return (j.select("parent_event_code", F.col("m_brand_name").alias("brand_name"),
                     F.col("m_prod_merch_l10_code").alias("prod_merch_l10_code"),
                     F.col("m_prod_merch_l10_desc").alias("prod_merch_l10_desc"))
            .distinct())


def dominant_brand(brand_cats: DataFrame) -> DataFrame:
    """Per parent event the brand with the most distinct L10 entries (ties: the
    alphabetically first brand), with that brand's first L10 desc as category.

    The window runs on the per-(event, brand) counts, so an event's partition
    holds one row per brand however many products it nominated."""
    counts = brand_cats.groupBy("parent_event_code", "brand_name").agg(
        F.count("brand_name").alias("l10_count"),
        F.min("prod_merch_l10_desc").alias("category"))
    best = best_per_group(counts, ["parent_event_code"],
                          [F.desc("l10_count"), F.asc_nulls_last("brand_name")])
    return best.select("parent_event_code", "brand_name", "category")


def flag_nominations(selected: DataFrame, dominant: DataFrame, nominated: DataFrame,
                     salts: int | None = None) -> DataFrame:
    """Selected nominations + dominant brand/category + prod_found_flag (0/1).

    ``salts`` spreads a hot parent event over that many tasks when the
    per-week results are too large to broadcast (see ``left_join``)."""
    flag = (nominated.select("parent_event_code", "line_item_id").distinct()
            .withColumn("prod_found_flag", F.lit(1)))
    out = left_join(selected, dominant, ["parent_event_code"], salts)
    out = left_join(out, flag, ["parent_event_code", "line_item_id"], salts, measure=selected)
    return out.fillna({"prod_found_flag": 0})


def apply_hook(df: DataFrame, fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Optional caller-supplied DataFrame -> DataFrame step."""
    if fn is None:
        return df
    out = fn(df)
    return check_frame(out, "result of the hook")


def with_rerun(selected: DataFrame, re_run_events: DataFrame | None, enabled: bool,
               run_date: _dt.date | None, weekday: int, salts: int | None = None,
               measure: DataFrame | None = None) -> DataFrame:
    """When enabled and ``run_date`` falls on ``weekday`` (Monday = 0), attach
    the events' re-run marker with a LEFT join (a parameter check on the
    driver, not a data scan).  ``salts`` and ``measure``: see ``salted_join``."""
    if not enabled or run_date is None or re_run_events is None:
        return selected
    if run_date.weekday() != int(weekday):
        return selected
    rr = re_run_events.select("parent_event_code", "re_run").distinct()
    return left_join(selected, rr, ["parent_event_code"], salts, measure)


def brands_and_categories(selected: DataFrame, brand_cats: DataFrame) -> DataFrame:
    """Per parent event: sorted distinct brands and categories as text ('' when
    none) and, when present, the event's smallest nomination code.

    Built from the unranked brand/category set.  The lists hold distinct values
    only (collect_set merges map-side), so their size is the vocabulary of one
    event, not its row count."""
    lists = brand_cats.groupBy("parent_event_code").agg(
        sorted_distinct_text("brand_name").alias("brands"),
        sorted_distinct_text("prod_merch_l10_desc").alias("categories"))
    if "nomination_code" in selected.columns:
        base = selected.groupBy("parent_event_code").agg(F.min("nomination_code").alias("nomination_code"))
    else:
        base = selected.select("parent_event_code").distinct()
    out = base.join(lists, "parent_event_code", "left").fillna({"brands": "", "categories": ""})
    cols = ["parent_event_code", "brands", "categories"]
    return out.select(*cols, *(["nomination_code"] if "nomination_code" in base.columns else []))


# --------------------------------------------------------------------------- N13
@dataclass
class NominationParams:
    current_week: object = None
    event_types: Sequence[str] = ("AAA",)
    re_run: bool = False
    re_run_day: int = 0
    current_date: _dt.date | None = None
    hook: Callable[[DataFrame], DataFrame] | None = None
    salts: int | None = None      # tasks over which a very common parent event is spread in N9 and N11
    tables: Mapping[str, str] = field(default_factory=dict)   # optional materialization names


def build_nominations(nomination_prod: DataFrame, prod: DataFrame, selected: DataFrame,
                      mappings: Mapping[str, Mapping[str, str]] | None,
                      params: NominationParams, re_run_events: DataFrame | None = None):
    """N1-N12 end to end.  Returns (final products, nominations, brand/category lists).

    ``mappings`` has the logical -> physical maps ``nomination_prod``, ``prod``,
    ``nomination`` and ``event``.  Missing maps raise RuntimeError, missing keys
    KeyError, non-frames ValueError.  Steps fail loudly: there is no
    best-effort empty result.
    """
    frames = {"nomination_prod": nomination_prod, "prod": prod, "selected": selected}
    if re_run_events is not None:
        frames["re_run_events"] = re_run_events
    for what, frame in frames.items():
        check_frame(frame, what)
    names = check_mapping(mappings, "the inputs")
    per_input = {k: check_mapping(names.get(k), k) for k in ("nomination_prod", "prod", "nomination", "event")}
    np_ = canonicalize(nomination_prod, per_input["nomination_prod"], NOM_PROD_KEYS, "nomination_prod")
    pr = canonicalize(prod, per_input["prod"], PROD_KEYS, "prod")
    for what, keys in (("nomination", NOMINATION_KEYS), ("event", EVENT_KEYS)):
        lacking = [k for k in keys if k not in per_input[what]]
        if lacking:
            raise KeyError(f"{what}: logical columns without a physical name: {lacking}")
    event_code = per_input["event"]["parent_event_code"]
    sel_map = {**{k: k for k in SELECTED_KEYS}, **per_input["nomination"], "parent_event_code": event_code}
    # other nomination-level columns are carried, unless their name is a logical one
    used = set(sel_map) | set(sel_map.values())
    sel_map.update({c: c for c in selected.columns if c not in used})
    sel = canonicalize(selected, sel_map, SELECTED_KEYS, "selected")
    rr = None
    if re_run_events is not None:
        rr = canonicalize(re_run_events, {"parent_event_code": event_code,
                                          "re_run": per_input["event"].get("re_run", "re_run")},
                          ("parent_event_code", "re_run"), "re_run_events")

    # the week's nominations and the master rows of their weeks feed every later step: computed once
    nominated = checkpoint(nominated_products(np_, sel, params.current_week, params.event_types))
    weeks = nominated.select(F.explode(F.array("nomination_start_week", "event_start_week")).alias("week"))
    master = checkpoint(product_master(pr.where(in_weeks_of(weeks, "week"))))
    line_items = checkpoint(line_item_products(nominated))
    final = nomination_product_sets(line_items, master)
    final = materialize(final, params.tables.get("final_nomination_prod_info"))
    bc = event_brand_categories(nominated, master)
    noms = flag_nominations(sel, dominant_brand(bc), nominated, params.salts)
    noms = apply_hook(noms, params.hook)
    noms = with_rerun(noms, rr, params.re_run, params.current_date, params.re_run_day, params.salts, sel)
    noms = materialize(noms, params.tables.get("interim_nominations_table"))
    noms = materialize(noms, params.tables.get("final_nominations_table"))
    lists = brands_and_categories(noms, bc)
    return final, noms, lists
