"""regfold: turn nested register extracts into flat, partitioned Parquet tables on Spark.

Layout:
  session      -- the one place a SparkSession is configured (S17)
  sources/     -- test tables, nested main tables, XML, archives, landing listings
  operators/   -- the six projection shapes, paging, merge, audit
  functions/   -- column functions for names, dates and paths
  plans/       -- table specs (data), fan-out, publish
  streaming/   -- consume-once intake of dropped files
"""

__version__ = "0.1.0"
