"""Transaction-risk analytics as Spark DataFrame operators.

Sub-packages:

* ``functions``  column expressions and row-local features
* ``operators``  quality checks, profiling, windows, ranking, metrics, views, models
* ``sources``    readers, sinks and the adapter from the generic event tables
* ``plans``      compositions: preprocessing, feature sets, evaluation and monitoring runs
* ``streaming``  the same logic on Structured Streaming
* ``catalog``    named queries with the SQL they are checked against
"""

__version__ = "0.1.0"
