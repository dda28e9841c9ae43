"""Parameters of the registered queries (shared by the Spark side and the SQL oracle)."""

from __future__ import annotations

from types import SimpleNamespace

P = SimpleNamespace(
    top_k=3,                          # top customers
    colour_k=1,                       # most-sold colour
    item="blue bolt",                 # distinct buyers of this item
    negative_limit=100,
    violation_limit=100,
    credit_share=0.1,
    approx_rsd=0.05, approx_sigmas=4.0,
    salts=8,                          # tasks over which a very common customer or event is spread
    sales_partitions=16,
    as_of="2000-01-01 00:00:00",      # future-timestamp check reference point
    balance_lo=0.0, balance_hi=10000.0,
    project_status=("O", "F", "P"),
    url_regex=r"^https://[^/ ]+[.][a-z]+([/?#].*)?$",
    roles=("user", "assistant"),
    current_week=19980601,            # Monday (yyyymmdd) of the nominated week
    event_types=("AAA",),
    re_run_day=0,                     # Monday
    run_date="1998-06-01",
    seed=42,
    cutoff="1997-03-10", second_cutoff="1997-03-24",     # slices that are taken in one after the other
    month=("1996-05-01", "1996-06-01"),                  # range that the layout serves
    row_group_bytes=1 << 20,
)
