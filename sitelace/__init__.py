"""Entity resolution, geospatial enrichment and corpus preparation on PySpark."""
