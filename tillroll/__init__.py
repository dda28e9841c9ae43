"""tillroll: retail analytics and data-quality operators on Spark.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing is
collected to the driver; planning and execution stay with Catalyst and AQE.

Layout
------
sources/    reading the driver tables, catalog writes, schemas, generators
functions/  column-expression helpers (dates, money, predicates)
operators/  generic relational and data-quality operators
plans/      user-level analyses built from the operators
streaming/  the row-level checks and sales totals on a streaming source
"""

from tillroll.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
