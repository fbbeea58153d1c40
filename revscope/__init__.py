"""revscope — product-review analytics as plain Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark's own expressions (no Python UDFs, no custom planner rules), so it can
be chained with ``DataFrame.transform`` and optimised by Catalyst.
"""

__version__ = "0.1.0"
