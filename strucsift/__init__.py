"""strucsift: curation of atomistic-structure datasets as Spark DataFrame jobs.

Three stages, each a function over DataFrames:

* ``plans.process``  raw structures -> typed query table,
* ``plans.select``   predicate, allowlist and sampling -> set of entry keys,
* ``plans.export``   entry keys -> training records with extra columns.
"""
