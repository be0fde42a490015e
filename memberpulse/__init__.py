"""memberpulse — membership and engagement analytics as Spark DataFrame operators.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions`` and Catalyst built-ins (no Python UDFs; only the byte-for-byte
archive copies files in Python tasks).  Run-time
inputs such as the run date (``as_of``), the wall clock (``now``), the random
seed and the local time zone are explicit parameters; nothing reads the clock.

Sub-packages:

* ``functions``  column-level helpers: calendar, ratios, label predicates
* ``operators``  the report, KPI, upkeep and registry operators
* ``sources``    readers, writers and the test-table adapters
* ``plans``      named queries, the DuckDB oracle texts and the three jobs
"""

from memberpulse.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
