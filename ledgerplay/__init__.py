"""ledgerplay: lending and game-log analytics as Spark DataFrame operators.

Every operator is a plain function ``fn(df, ...) -> DataFrame`` (usable with
``df.transform``).  Sub-packages:

* ``sources``    scans, text parsers and sinks
* ``functions``  Column-level formulas (normal distribution, finance, hashing)
* ``operators``  cleaning, joins, aggregates, windows, tests, cashflows, game logs
* ``plans``      bindings of the lending / game tables onto the test tables and
                 the registered query catalogue
* ``streaming``  micro-batch adaptors of the batch operators
"""

from ledgerplay.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
