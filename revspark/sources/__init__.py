"""Sources and sinks.

schemas   declared schemas and the registry of the nine raw tables
csv       CSV ingestion: missing-value tokens, lenient dates, missing files, load audit
sinks     full-refresh tables, views, mart writes, CSV export, land-once tables
testdata  the nine raw tables derived from the driver's TPC-H-style parquet files
"""
