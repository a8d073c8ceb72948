"""Single files for people: CSV dialects, GeoJSON, an HTML map.  Between stages data stay in Parquet."""
