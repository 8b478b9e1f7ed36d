"""recsift: candidate-generation (recall) data jobs for recommenders, written as Spark DataFrame plans.

Every job takes DataFrames and returns a lazy DataFrame; nothing is collected to the driver.
Sub-packages:

* ``sources``   - input contracts, readers/writers for the text list formats, test-table adapters.
* ``functions`` - column-expression builders (hashing, bucketing, CTR, dates, prices).
* ``operators`` - whole-table operators and composite jobs (item CF, Swing, re-rank, NDCG, ...).
* ``plans``     - session set-up and the registry of named queries with their SQL twins.
"""

__version__ = "0.1.0"
