"""velolake: Spark-native analytics for shared-mobility station readings and
hourly weather.

Every operator is a ``DataFrame -> DataFrame`` function (use ``df.transform``)
built from Spark SQL expressions, so Catalyst can push filters into the scan,
prune columns and plan partial aggregation.  Nothing collects rows to the
driver except model fitting and single-row folder-name lookups in sinks.
"""

__version__ = "0.1.0"
