"""roostline: short-stay lodging analytics as PySpark DataFrame operators.

Sub-packages

* ``sources``   - schemas and readers of the four raw tables
* ``functions`` - Column expressions (amenity sets, keys, dates, exact numbers)
* ``operators`` - reusable table operators (intervals, islands, ranks, skew)
* ``plans``     - staging, history, dimensions, facts, analyses, the whole run
* ``sinks``     - layer routing, table replace, keyed upsert with schema sync
* ``quality``   - column checks and run gates
* ``streaming`` - late data: the rolling reprocess window and its check
"""
