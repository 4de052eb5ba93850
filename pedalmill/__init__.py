"""pedalmill: mobility analytics as Spark DataFrame operators.

Layers, lowest first:

* ``functions``  column expressions (dates, bins, text, geometry, parsing, ratios)
* ``sources``    readers, file manifests and sinks
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      jobs composed of operators (trip ETL, crosswalk, weather models)
* ``streaming``  incremental file ingest
* ``catalog``    the registered queries and the SQL each is checked against
"""

__version__ = "0.1.0"
