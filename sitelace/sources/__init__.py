"""Readers: HTTP services as data sources, delimited files, workbooks."""
