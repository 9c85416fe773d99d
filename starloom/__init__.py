"""starloom - a dimensional warehouse (star schema with slowly changing
dimensions) built from operational order data, on Spark DataFrames.

Entry points:

* ``starloom.sources.Source`` - the operational source (parquet / catalog / JDBC)
* ``starloom.plans.loads`` - ``init_warehouse``, ``full_load``, ``incremental_load``
* ``starloom.plans.warehouse.Warehouse`` - published tables and control state
* ``starloom.plans.validation.run_checks`` and ``starloom.operators.quality`` - checks and reports
* ``starloom.streaming.micro_batch`` - incremental loads driven by a stream
* ``python -m starloom`` - the same workflow from the command line
"""

__version__ = "0.1.0"
