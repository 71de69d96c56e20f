"""propval: property-valuation analytics on Spark.

Every public function maps DataFrames to DataFrames using the Spark SQL,
DataFrame and Spark ML public APIs.  Sub-packages:

* ``sources``   - table loading, CSV/Parquet scans and sinks, fixture views
* ``functions`` - column-expression helpers (keys, tiers, text, safe math)
* ``operators`` - the analytics operators (extract, features, metrics, ...)
* ``plans``     - the registered queries and their DuckDB oracle SQL
* ``streaming`` - the same column logic applied to a streaming DataFrame
"""

__version__ = "0.1.0"
