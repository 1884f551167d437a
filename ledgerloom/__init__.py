"""ledgerloom: warehouse preparation as Spark DataFrame plans.

Modules
-------
functions/  column expressions (chunk ids, calendar labels, row text, trigrams)
operators/  DataFrame -> DataFrame operations (attributes, time dimensions,
            rate series, checks, enums, sketches, chunk selection)
sources/    readers and writers (wide rate files, catalog listings, table
            layouts, schema copy and publish)
plans/      the named queries registered for the driver, with their SQL twins
streaming/  nothing to stream: the original toolkit has no streaming code
"""

__version__ = "0.1.0"
