"""histlake: historised-snapshot analytics on Spark DataFrames.

Every public operator is a function ``DataFrame -> DataFrame`` that takes its
keys, sequence column and tracked columns as arguments, so the payroll schema
is one configuration among many.  Sub-packages:

* ``sources``   - batch / streaming Parquet readers, typed appends, layout writers
* ``operators`` - keys and tenure, SCD1/SCD2, snapshot, summaries, audit, profile
* ``functions`` - column-level helpers (text clean-up, URL encoding, dates)
* ``plans``     - the analog relations, the registered query set, ``refresh``
* ``streaming`` - Structured Streaming jobs (ingest, reference tables, CDC)

The most used operators are re-exported here.
"""

from histlake.operators.audit import last_run, work_list  # noqa: F401
from histlake.operators.keys import with_key_and_tenure  # noqa: F401
from histlake.operators.reference import position_reference, reference_names, translate  # noqa: F401
from histlake.operators.scd import as_of, current, scd1, scd2  # noqa: F401
from histlake.operators.snapshot import inactive, latest_snapshot  # noqa: F401
from histlake.operators.summaries import employee_summary, group_summary  # noqa: F401
from histlake.session import build_session, scratch_dir  # noqa: F401

__all__ = ["build_session", "scratch_dir", "with_key_and_tenure", "scd1", "scd2", "current",
           "as_of", "latest_snapshot", "inactive", "employee_summary", "group_summary",
           "reference_names", "position_reference", "translate", "last_run", "work_list"]
