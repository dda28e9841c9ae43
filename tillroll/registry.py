"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the driver's whole tables (through the adapters).  Queries
are lazy except those that store an intermediate: the catalog round trips and
the fused nomination sets write when called, under new names and in new folders
of the shared checkpoint folder; checks of relations and the product master count
their tables' rows (in the files' footers), to deal large ones to more tasks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.params import P
from tillroll.session import unique_name
from tillroll.plans import calendar as C
from tillroll.plans import constraints as CO
from tillroll.plans import factorised as FA
from tillroll.plans import incremental as I
from tillroll.plans import nominations as N
from tillroll.plans import orders as Q
from tillroll.plans import sales as SA
from tillroll.plans import shop as S
from tillroll.plans import suite as SU
from tillroll.operators import quality as V
from tillroll.sources.tables import table
from tillroll.sources import adapters as A
from tillroll.sources import catalog as IO
from tillroll.sources import generate as G
from tillroll.sources import layout as L

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Report DATE columns as midnight timestamp_ntz (a zone-free cast), so a
    result reads the same from every engine and client library."""
    if not any(isinstance(f.dataType, T.DateType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.DateType) else F.col(f.name)
                       for f in df.schema.fields])


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, d: portable(fn(spark, d))
        return fn
    return deco


# ----------------------------------------------------------------------------- order analytics
@register("top_customers")
def _top_customers(spark, d):
    return Q.top_customers(A.customers(spark, d), A.orders(spark, d), P.top_k, P.salts)


@register("top_customers_preagg")
def _top_customers_preagg(spark, d):
    return Q.top_customers_preagg(A.customers(spark, d), A.orders(spark, d), P.top_k)


def _stored(df, what):
    """``df`` as an intermediate in a new folder of the shared checkpoint location."""
    path = IO.scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _finished(df, *tables):
    """The (small) result, stored, once the tables that it was read from are dropped."""
    out = IO.checkpoint(df)
    for name in tables:
        IO.drop_table(df.sparkSession, name)
    return out


def _monthly(spark, d):
    return Q.monthly_category_qty(A.orders(spark, d), A.order_items(spark, d), A.products(spark, d))


@register("top_category_per_month")
def _top_category_per_month(spark, d):
    return Q.top_category_per_month(A.orders(spark, d), A.order_items(spark, d),
                                    A.products(spark, d), A.categories(spark, d))


@register("top_category_per_month_reuse")
def _top_category_per_month_reuse(spark, d):
    stored = _stored(_monthly(spark, d), "monthly_category_qty")
    return Q.top_category_per_month_reuse(stored, A.categories(spark, d))


@register("avg_order_value_by_month")
def _avg_order_value_by_month(spark, d):
    return Q.avg_order_value_by_month(A.orders(spark, d))


@register("avg_monthly_revenue")
def _avg_monthly_revenue(spark, d):
    return Q.avg_monthly_revenue(A.orders(spark, d))


@register("monthly_order_stats")
def _monthly_order_stats(spark, d):
    return Q.monthly_order_stats(A.orders(spark, d))


@register("returned_orders_by_month")
def _returned_orders_by_month(spark, d):
    return Q.returned_orders_by_month(A.returns(spark, d))


@register("returned_orders_by_month_approx")
def _returned_orders_by_month_approx(spark, d):
    return Q.approximation_check(A.returns(spark, d), P.approx_rsd, P.approx_sigmas)


# ----------------------------------------------------------------------------- shop
@register("units_by_attr")
def _units_by_attr(spark, d):
    return S.units_by_attr(A.shop_order_products(spark, d), A.shop_products(spark, d), "item_colour")


@register("top_attr")
def _top_attr(spark, d):
    return S.top_attr(A.shop_order_products(spark, d), A.shop_products(spark, d), "item_colour",
                      P.colour_k)


@register("distinct_buyers")
def _distinct_buyers(spark, d):
    return S.distinct_buyers(A.shop_orders(spark, d), A.shop_order_products(spark, d),
                             A.shop_products(spark, d), P.item)


# ----------------------------------------------------------------------------- sales
@register("clean_sales")
def _clean_sales(spark, d):
    return SA.clean_sales(A.sales_transactions(spark, d))


@register("sales_by_year")
def _sales_by_year(spark, d):
    s = A.sales_transactions(spark, d, ["amount", "quantity", "transaction_date"])
    return SA.sales_by_year(s)


@register("sales_by_payment")
def _sales_by_payment(spark, d):
    s = A.sales_transactions(spark, d, ["amount", "quantity", "payment_mode"])
    return SA.sales_by_payment(s)


@register("negative_transactions")
def _negative_transactions(spark, d):
    s = A.sales_transactions(spark, d, ["transaction_id", "customer_id", "transaction_date", "amount",
                                        "quantity", "payment_mode", "store_location"])
    return SA.negative_transactions(s, P.negative_limit)


@register("credit_debit_violations")
def _credit_debit_violations(spark, d):
    s = A.sales_transactions(spark, d, ["customer_id", "amount", "quantity", "payment_mode"])
    return SA.credit_debit_violations(s, P.credit_share, P.violation_limit)


# ----------------------------------------------------------------------------- calendars
@register("calendar_iso")
def _calendar_iso(spark, d):
    return C.calendar_for(A.orders(spark, d), "created_at", "iso")


@register("calendar_strftime")
def _calendar_strftime(spark, d):
    return C.calendar_for(A.orders(spark, d), "created_at", "strftime")


# ----------------------------------------------------------------------------- data quality
def _tracker(spark, d):
    return {"users": A.tracker_users(spark, d, with_created=True), "projects": A.tracker_projects(spark, d),
            "tasks": A.tracker_tasks(spark, d, with_project=True), "task_refs": A.tracker_tasks(spark, d)}


#: The driver's table that each checked table's rows come from.
CHECKED_ROWS = {"users": "customer", "projects": "orders", "tasks": "lineitem", "task_refs": "lineitem", "labels": "labels",
                "documents": "documents", "document_refs": "documents", "pages": "pages", "turns": "conversations"}


def _tasks(spark, d, tables):
    return {t: A.tasks_of(spark, d, CHECKED_ROWS[t]) for t in tables}


@register("missing_required")
def _missing_required(spark, d):
    return V.missing_required(A.corpus_tables(spark, d)["documents"], not_null=["quality"], not_blank=["source"],
                              keep=["doc_id", "source"], check="document without a quality label")


@register("duplicate_keys")
def _duplicate_keys(spark, d):
    docs = table(spark, d, "documents")
    return V.duplicate_keys(docs, ["text"], "doc_id", check="text occurs more than once", hashed=True)


@register("pattern_violation")
def _pattern_violation(spark, d):
    return V.pattern_violation(table(spark, d, "pages"), "url", P.url_regex, keep=["page_id", "url"],
                               check="page url of another form")


@register("whitespace_violation")
def _whitespace_violation(spark, d):
    return V.whitespace_violation(A.page_titles(spark, d), "title", keep=["page_id", "title"],
                                  check="page title with outer blanks")


@register("not_in_set")
def _not_in_set(spark, d):
    return V.not_in_set(A.corpus_tables(spark, d)["turns"], "role", P.roles, keep=["conv_id", "turn", "role"],
                        check="turn role not on the list")


@register("out_of_range")
def _out_of_range(spark, d):
    return V.out_of_range(A.tracker_users(spark, d), "balance", P.balance_lo, P.balance_hi,
                          keep=["id", "balance"], check="user balance beyond its limits")


@register("orphans")
def _orphans(spark, d):
    t = A.corpus_tables(spark, d)
    return V.orphans(t["document_refs"], "doc_id", t["labels"], "doc_id", keep=["doc_id", "source"],
                     check="document that nobody labelled", tasks=A.tasks_of(spark, d, "documents"))


@register("future_timestamps")
def _future_timestamps(spark, d):
    return V.future_timestamps(A.tracker_projects(spark, d), "created_at", P.as_of,
                               keep=["id", "created_at"], check="project dated ahead")


@register("precedes")
def _precedes(spark, d):
    t = A.tracker_tasks(spark, d, with_project=True)
    return V.precedes(t, F.col("created_at").cast("date"), "due_date",
                      keep=["project_id", "line", "created_at", "due_date"],
                      check="task due before its creation")


@register("childless")
def _childless(spark, d):
    return V.childless(A.tracker_projects(spark, d), "id", A.tracker_tasks(spark, d), "project_id",
                       keep=["id", "owner_id"], check="project without tasks")


@register("matching_parent_attr")
def _matching_parent_attr(spark, d):
    return V.matching_parent_attr(A.tracker_tasks(spark, d), "project_id", A.tracker_projects(spark, d),
                                  "id", "assignee_id", "owner_id",
                                  keep=["project_id", "line", "assignee_id", "owner_id"],
                                  check="task assigned to the project's owner")


@register("row_counts")
def _row_counts(spark, d):
    return V.row_counts({"users": A.tracker_users(spark, d), "projects": A.tracker_projects(spark, d),
                         "tasks": A.tracker_tasks(spark, d)})


def _all_checks():
    return (SU.tracker_checks(P.as_of, P.project_status, balance=(P.balance_lo, P.balance_hi))
            + SU.corpus_checks(P.url_regex, P.roles))


@register("validation_summary")
def _validation_summary(spark, d):
    tables = {**_tracker(spark, d), **A.corpus_tables(spark, d)}
    return SU.summarize_checks(tables, _all_checks(), tasks=_tasks(spark, d, tables))


@register("validation_details")
def _validation_details(spark, d):
    tables = {**_tracker(spark, d), **A.corpus_tables(spark, d)}
    return SU.run_details(tables, _all_checks(), tasks=_tasks(spark, d, tables))


@register("validation_summary_observed")
def _validation_summary_observed(spark, d):
    """The summary that falls out while the details are written."""
    tables = {**_tracker(spark, d), **A.corpus_tables(spark, d)}
    return SU.store_suite(tables, _all_checks(), lambda found: _stored(found, "violations"),
                          tasks=_tasks(spark, d, tables))[1]


#: Constraints of the driver's tables, as column metadata.
CONSTRAINED = {
    "users": T.StructType([
        CO.column("id", T.LongType(), required=True, unique=True),
        CO.column("username", T.StringType(), required=True, pattern=r"^Customer#[0-9]+$"),
        CO.column("segment", T.StringType(), required=True, allowed=["AUTOMOBILE", "BUILDING", "MACHINERY"]),
        CO.column("balance", T.DoubleType(), between=[P.balance_lo, P.balance_hi])]),
    "projects": T.StructType([
        CO.column("id", T.LongType(), required=True, unique=True),
        CO.column("owner_id", T.LongType(), required=True, references="users.id"),
        CO.column("status", T.StringType(), required=True, allowed=list(P.project_status))]),
    "tasks": T.StructType([
        CO.column("project_id", T.LongType(), required=True, references="projects.id"),
        CO.column("line", T.IntegerType(), required=True, between=[1, 6]),
        CO.column("assignee_id", T.LongType(), references="users.id")]),
    "labels": T.StructType([CO.column("doc_id", T.LongType(), required=True, unique=True),
                            CO.column("quality", T.IntegerType(), allowed=[1])]),
    "documents": T.StructType([CO.column("doc_id", T.LongType(), required=True, references="labels.doc_id"),
                               CO.column("source", T.StringType(), required=True)]),
}
CONSTRAINED_KEYS = {"users": ["id"], "projects": ["id"], "tasks": ["project_id", "line"], "labels": ["doc_id"],
                    "documents": ["doc_id"]}


def _constrained(spark, d):
    texts = A.corpus_tables(spark, d)
    tables = {"users": A.tracker_users(spark, d), "projects": A.tracker_projects(spark, d), "tasks": A.tracker_tasks(spark, d),
              "labels": texts["labels"], "documents": texts["document_refs"]}
    return tables, CO.compile_checks(CONSTRAINED, CONSTRAINED_KEYS), None, _tasks(spark, d, tables)


@register("constraint_summary")
def _constraint_summary(spark, d):
    return SU.summarize_checks(*_constrained(spark, d))


@register("constraint_violations")
def _constraint_violations(spark, d):
    return SU.run_details(*_constrained(spark, d))


# ----------------------------------------------------------------------------- nominations
def _nominations(spark, d):
    sel = A.selected_nominations(spark, d)
    master = N.product_master(A.prod(spark, d))
    np_ = A.nomination_prod(spark, d, P.current_week, P.event_types)
    nominated = N.nominated_products(np_, sel, P.current_week, P.event_types)
    return sel, master, nominated, N.line_item_products(nominated)


@register("nominated_products")
def _nominated_products(spark, d):
    return _nominations(spark, d)[2]


@register("line_item_products")
def _line_item_products(spark, d):
    return _nominations(spark, d)[3]


@register("product_master")
def _product_master(spark, d):
    return N.product_master(A.prod(spark, d, A.tasks_of(spark, d, "lineitem")))


@register("featured_products")
def _featured_products(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.featured_products(li, master)


@register("brand_products")
def _brand_products(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.brand_products(li, master)


@register("category_products")
def _category_products(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.category_products(li, master)


@register("final_nomination_products")
def _final_nomination_products(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.nomination_product_sets(li, master)


def _classes(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.nomination_classes(li, master)


@register("category_classes")
def _category_classes(spark, d):
    """The classes' products with the line items that reach them: as many rows as products, not as links."""
    return FA.class_rows(_classes(spark, d))


@register("category_members")
def _category_members(spark, d):
    """The line items' classes: as many rows as line items have L10 codes and brands."""
    return _classes(spark, d).members


@register("category_class_links")
def _category_class_links(spark, d):
    return FA.total_links(_classes(spark, d))


@register("nomination_link_counts")
def _nomination_link_counts(spark, d):
    return FA.item_links(_classes(spark, d))


@register("final_products_from_classes")
def _final_products_from_classes(spark, d):
    """The factorised relation multiplied out."""
    return FA.expand_final(_classes(spark, d))


@register("featured_products_salted")
def _featured_products_salted(spark, d):
    _, master, _, li = _nominations(spark, d)
    return N.featured_of(N.nominated_attributes(li, master, P.salts))


@register("category_products_by_week")
def _category_products_by_week(spark, d):
    """From a master stored by week: only the folders of the nominated weeks are read."""
    _, master, _, li = _nominations(spark, d)
    stored = IO.write_partitioned(master, None, ["fis_week_id"], path=IO.scratch_path(spark, "master_by_week"))
    return N.category_products(li, stored)


@register("dominant_brand")
def _dominant_brand(spark, d):
    _, master, nominated, _ = _nominations(spark, d)
    return N.dominant_brand(N.event_brand_categories(nominated, master))


@register("flag_nominations")
def _flag_nominations(spark, d):
    sel, master, nominated, _ = _nominations(spark, d)
    dom = N.dominant_brand(N.event_brand_categories(nominated, master))
    return N.flag_nominations(sel, dom, nominated, P.salts)


@register("with_rerun")
def _with_rerun(spark, d):
    flagged = _flag_nominations(spark, d)
    return N.with_rerun(flagged, A.re_run_events(spark, d), True,
                        _dt.date.fromisoformat(P.run_date), P.re_run_day, P.salts, A.selected_nominations(spark, d))


@register("brands_and_categories")
def _brands_and_categories(spark, d):
    sel, master, nominated, _ = _nominations(spark, d)
    return N.brands_and_categories(sel, N.event_brand_categories(nominated, master))


#: Physical names of the inputs of the end-to-end pipeline.
MAPPINGS = {
    "nomination_prod": {k: f"np_{k}" for k in N.NOM_PROD_KEYS},
    "prod": {k: f"pr_{k}" for k in N.PROD_KEYS},
    "nomination": {k: f"no_{k}" for k in N.SELECTED_KEYS if k != "parent_event_code"},
    "event": {"parent_event_code": "ev_parent", "re_run": "ev_re_run"},
}


def _built(spark, d):
    """(final products, nominations, lists) over inputs with physical column names."""
    def renamed(df, names):
        return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})

    event = MAPPINGS["event"]
    params = N.NominationParams(P.current_week, P.event_types, True, P.re_run_day, _dt.date.fromisoformat(P.run_date),
                                salts=P.salts)
    return N.build_nominations(
        renamed(A.nomination_prod(spark, d, P.current_week, P.event_types), MAPPINGS["nomination_prod"]),
        renamed(A.prod(spark, d), MAPPINGS["prod"]),
        renamed(A.selected_nominations(spark, d), {**MAPPINGS["nomination"], **event}),
        MAPPINGS, params, renamed(A.re_run_events(spark, d), event))


@register("nominations_final")
def _nominations_final(spark, d):
    return _built(spark, d)[0]


@register("nominations_flagged")
def _nominations_flagged(spark, d):
    return _built(spark, d)[1]


@register("nominations_lists")
def _nominations_lists(spark, d):
    return _built(spark, d)[2]


# ----------------------------------------------------------------------------- catalog round trips
@register("materialize_roundtrip")
def _materialize_roundtrip(spark, d):
    return _stored(Q.monthly_order_stats(A.orders(spark, d)), "monthly_order_stats")


@register("materialize_named")
def _materialize_named(spark, d):
    """A named table is stored, replaced by what is computed from it, read back and dropped."""
    name = unique_name("tillroll_order_totals")
    orders = A.orders(spark, d).select("created_at", "total_amount")
    IO.materialize(orders.where(F.col("created_at") < F.lit(P.cutoff).cast("timestamp_ntz")), name)
    late = orders.where(F.col("created_at") >= F.lit(P.cutoff).cast("timestamp_ntz"))
    both = IO.materialize(spark.table(name).unionByName(late), name)
    return _finished(Q.monthly_order_stats(both), name)


@register("ctas_summary")
def _ctas_summary(spark, d):
    name = unique_name("tillroll_order_stats")
    stats = IO.ctas(Q.monthly_order_stats(A.orders(spark, d)), name, path=IO.scratch_path(spark, "order_stats"))
    return _finished(Q.avg_monthly_revenue_from_stats(stats), name)


@register("resolve_source")
def _resolve_source(spark, d):
    s = A.sales_transactions(spark, d, ["amount", "quantity", "transaction_date", "payment_mode"])
    name = unique_name("tillroll_sales_clean")
    IO.overwrite(SA.clean_sales(s), name, path=IO.scratch_path(spark, "sales_clean"))
    return _finished(SA.sales_by_year(IO.resolve_source(spark, [name + "_v2", name])), name)


@register("resolve_raw_source")
def _resolve_raw_source(spark, d):
    """No cleaned table is stored: the raw one is found, and the year comes from the date."""
    s = A.sales_transactions(spark, d, ["amount", "quantity", "transaction_date"])
    name = unique_name("tillroll_sales_raw")
    IO.overwrite(s, name, path=IO.scratch_path(spark, "sales_raw"))
    return _finished(SA.sales_by_year(IO.resolve_source(spark, [name + "_clean", name])), name)


@register("layout_roundtrip")
def _layout_roundtrip(spark, d):
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = unique_name("tillroll_orders_by_customer")
    laid = IO.write_layout(A.orders(spark, d), name, ["customer_id"],
                           buckets=buckets, sort_by=["created_at"], path=IO.scratch_path(spark, "orders_by_customer"))
    return _finished(Q.top_customers_preagg(A.customers(spark, d), laid, P.top_k), name)


def _laid_out(spark, d, name):
    """Orders and customers bucketed alike by customer, very common customers apart."""
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    base = IO.scratch_path(spark, "colocated")
    # parquet filters on timestamps without a zone skip nothing, on dates they do
    dated = A.orders(spark, d).withColumn("day", F.col("created_at").cast("date"))
    orders = L.store(dated, name, ["customer_id"], buckets, ["created_at"], path=base + "/orders",
                     row_group_bytes=P.row_group_bytes)
    customers = A.customers(spark, d).select(F.col("id").alias("customer_id"), F.col("name").alias("customer_name"))
    return orders, L.store_beside(customers, name + "_names", orders, path=base + "/customers")


@register("top_customers_colocated")
def _top_customers_colocated(spark, d):
    """Join and sum inside the buckets: the rows of an order are never exchanged."""
    name = unique_name("tillroll_orders_laid_out")
    parts = L.colocated_join(*_laid_out(spark, d, name))
    return _finished(Q.top_spenders([Q.spend_of(p) for p in parts], P.top_k),
                     name, name + "__hot", name + "_names", name + "_names__hot")


@register("orders_of_one_month")
def _orders_of_one_month(spark, d):
    """A range of dates read from the layout: row groups and pages of other dates are skipped."""
    name = unique_name("tillroll_orders_by_day")
    orders = _laid_out(spark, d, name)[0].all()
    lo, hi = (F.lit(x).cast("date") for x in P.month)
    days = (orders.where((F.col("day") >= lo) & (F.col("day") < hi)).groupBy("day")
            .agg(F.count(F.lit(1)).alias("orders_count"), F.sum("total_amount").cast("double").alias("revenue")))
    return _finished(days, name, name + "__hot", name + "_names", name + "_names__hot")


# ----------------------------------------------------------------------------- summaries kept between runs
def _slices(col):
    """Three slices: before the cutoff, a fortnight after it (so a month is touched twice), the rest."""
    a, b = (F.lit(x).cast("timestamp_ntz") for x in (P.cutoff, P.second_cutoff))
    return [F.col(col) < a, (F.col(col) >= a) & (F.col(col) < b), (F.col(col) >= b) | F.col(col).isNull()]


@register("monthly_order_stats_incremental")
def _monthly_order_stats_incremental(spark, d):
    """Slices are taken in one after the other, one of them twice (as after a failure): equal to the whole computation."""
    orders = A.orders(spark, d)
    kept = I.order_totals(unique_name("tillroll_kept_totals"))
    I.taken_in_slices(kept, orders, _slices("created_at"), IO.scratch_path(spark, "kept_totals"))
    I.take_in(kept, spark, orders.where(_slices("created_at")[1]), "slice-1")
    return _finished(I.monthly_order_stats(kept, spark), kept.name)


@register("top_category_incremental")
def _top_category_incremental(spark, d):
    sold = (A.order_items(spark, d).join(A.orders(spark, d).select(F.col("id").alias("order_id"), "created_at"), "order_id")
            .join(A.products(spark, d).select(F.col("id").alias("product_id"), "category_id"), "product_id"))
    kept = I.category_quantities(unique_name("tillroll_kept_quantities"))
    I.taken_in_slices(kept, sold, _slices("created_at"), IO.scratch_path(spark, "kept_quantities"))
    I.compact(kept, spark, _dt.date.fromisoformat(P.cutoff))
    monthly = I.read(kept, spark).select(F.col("period").alias("month"), "category_id", "total_quantity")
    return _finished(Q.top_category_per_month_reuse(monthly, A.categories(spark, d)), kept.name)


@register("returned_orders_sketched")
def _returned_orders_sketched(spark, d):
    """Distinct counts from stored sketches, merged over the slices, against the exact counts."""
    returns = A.returns(spark, d)
    kept = I.returned_orders(unique_name("tillroll_kept_returns"))
    I.taken_in_slices(kept, returns, _slices("returned_at"), IO.scratch_path(spark, "kept_returns"))
    return _finished(Q.within_error(Q.returned_orders_by_month(returns), I.returned_orders_by_month(kept, spark),
                                    P.approx_sigmas * I.SKETCH_ERROR), kept.name)


def _generated(spark, d):
    return G.generate_sales(table(spark, d, "orders"), "o_orderkey", "o_custkey", "o_orderdate", P.seed)


@register("generate_sales")
def _generate_sales(spark, d):
    return _generated(spark, d)


@register("sales_with_generated")
def _sales_with_generated(spark, d):
    """Generated rows behind the originals, in a chosen number of partitions, then the totals of both."""
    both = G.append_generated(A.sales_transactions(spark, d, ["transaction_id", "amount", "quantity", "payment_mode"]),
                              _generated(spark, d), P.sales_partitions)
    return SA.sales_by_payment(both)
