"""Composite jobs built from the operators.

* ``corners``        corners from a JSON file and their join table
* ``catalogue``      the catalogue's tables by role, from a JSON file
* ``monthly_job``    the monthly job over the catalogue's own tables: material, album
                     dimension, fact, rollup, dedup; one corner, all corners, a month range,
                     newest-first publishing, and the runners that write, export and register
* ``star``           the same job mapped onto the driver's star schema
* ``star_catalogue`` the catalogue's own tables derived from the star schema
* ``driver_queries`` / ``oracle_sql``  the registered queries and their DuckDB oracles
* ``cli``            ``spark-submit`` entry point
"""
