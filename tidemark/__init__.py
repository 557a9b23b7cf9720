"""tidemark: retail ELT, snapshot and reconciliation jobs as Spark DataFrame plans.

Sub-packages
------------
sources    landed-file manifests, JSON-lines envelopes, delimited feeds, table sets
functions  column expressions with warehouse cast/parse parity
operators  latest-row-per-key, enrichment joins, counts, typing, quality checks, migrations
sinks      partition replacement, appends, CSV export, year/month relayout
plans      the snapshot / mart models and the registered stand-in queries
streaming  intraday hour rebuilds and hourly file counts on Structured Streaming
"""

__version__ = "0.1.0"
