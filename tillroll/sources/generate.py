"""Distributed generator of synthetic sales transactions.

One synthetic transaction per row of a driving frame (e.g. one per order),
attributes drawn from md5 digests of (seed, attribute, row id), so every executor
computes its own rows, the result does not depend on partitioning, and any
engine with md5 can draw the same rows.  Customers come from the driving rows,
so customers repeat across transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.relational import select_present

GIVEN = ["Ines", "Tomas", "Wen", "Adaeze", "Mirko", "Salma", "Jonas"]
FAMILY = ["Okafor", "Lindqvist", "Marchetti", "Tanaka", "Vasquez", "Novak"]
TOWNS = ["Tilburg", "Porto Alegre", "Kumasi", "Tampere", "Nagoya", "Cork"]
KINDS = ["Garden", "Kitchen", "Stationery", "Cycling"]
GOODS = ["kettle", "trowel", "notebook", "bell", "ladle", "pump", "seed tray"]
MODES = ["credit (chip)", "credit (online)", "debit (chip)", "cash", "voucher"]   # "credit"/"debit" decide the rule
RANGE = 1 << 32


def draw(seed: int, what: str, key: Column) -> Column:
    """A number in [0, 2**32): the first 8 hex digits of md5('seed|what|key')."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{what}|"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _pick(values: list[str], drawn: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (drawn % len(values) + 1).cast("int"))


def padded_id(prefix: str, number: Column, width: int = 3) -> Column:
    """``prefix`` and a whole number of at least ``width`` digits, zeros in front; longer numbers as they are."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def generate_sales(base: DataFrame, id_col: str, customer_col: str, date_col: str,
                   seed: int = 42, id_offset: int = 1000) -> DataFrame:
    """Sales transactions with the 16-column schema, one per ``base`` row.

    Amounts are 5.00 to 1999.99 in cents, quantities 1 to 5, about half of the
    rows have a discount of up to 20 %, about half are returns, loyalty points
    are amount // 10, the date is ``date_col`` less 0 to 30 days and up to a day
    of seconds.  All arithmetic is on integers (cents), so it is exact.
    """
    key = F.col(id_col)
    d = {w: draw(seed, w, key) for w in ("good", "kind", "cents", "quantity", "discount", "share", "return", "mode", "town",
                                         "rep", "given", "family", "day", "second")}
    cents = d["cents"] % 199500 + 500
    off = F.when(d["discount"] % 2 == 0, F.floor(cents * (d["share"] % 21) / 100)).otherwise(F.lit(0))
    when = F.col(date_col).cast("timestamp_ntz") - F.make_dt_interval(
        (d["day"] % 31).cast("int"), F.lit(0), F.lit(0), (d["second"] % 86400).cast("decimal(18,6)"))
    return base.select(
        padded_id("G", key + id_offset).alias("transaction_id"),
        padded_id("C", F.col(customer_col)).alias("customer_id"),
        F.concat_ws(" ", _pick(GIVEN, d["given"]), _pick(FAMILY, d["family"])).alias("customer_name"),
        F.concat(F.lit("P"), (d["good"] % len(GOODS)).cast("string")).alias("product_id"),
        _pick(GOODS, d["good"]).alias("product_name"),
        _pick(KINDS, d["kind"]).alias("category"),
        (cents / 100).cast("double").alias("amount"),
        (d["quantity"] % 5 + 1).cast("int").alias("quantity"),
        when.alias("transaction_date"),
        _pick(MODES, d["mode"]).alias("payment_mode"),
        _pick(TOWNS, d["town"]).alias("store_location"),
        (d["discount"] % 2 == 0).alias("discount_applied"),
        (off / 100).cast("double").alias("discount_amount"),
        F.floor(cents / 1000).cast("int").alias("loyalty_points_earned"),
        (d["return"] % 2 == 0).alias("is_return"),
        F.concat(F.lit("SR"), (d["rep"] % 9).cast("string")).alias("sales_rep"))


def append_generated(originals: DataFrame, generated: DataFrame, partitions: int | None = None) -> DataFrame:
    """The generated rows behind the original ones (columns of the originals; those
    that a generated row lacks are null), in ``partitions`` partitions if given."""
    out = originals.unionByName(select_present(generated, originals.columns), allowMissingColumns=True)
    return out.repartition(partitions) if partitions else out
