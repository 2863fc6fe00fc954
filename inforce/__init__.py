"""inforce — policy-term analytics on Spark DataFrames.

Operators are plain functions ``DataFrame(s) + parameters -> DataFrame``
built on the public DataFrame API so Catalyst plans them (pushdown,
pruning, partial aggregation) and AQE re-plans joins at run time.
"""

__version__ = "0.1.0"
