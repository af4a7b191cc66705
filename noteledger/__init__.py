"""noteledger: record-quality and multi-label text analytics on Spark.

Every operator is a plain function from DataFrame (or Column) to DataFrame
(or Column), built from Spark SQL expressions so Catalyst can prune, push
down and code-generate the whole plan.

Sub-packages:

* ``functions``  Column -> Column expressions (cleaning, lexicons, code rules)
* ``operators``  DataFrame -> DataFrame operators (reports, labels, splits,
  vectorizing, scoring, metrics, run tables, Spark ML models)
* ``sources``    readers, writers and the role frames derived from tables
* ``plans``      the named query catalogue and its SQL twins
* ``streaming``  incremental (micro-batch) forms of batch operators
"""

__version__ = "0.1.0"
