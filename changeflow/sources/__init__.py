"""Event streams, snapshot files, schema registries and destination catalogs as DataFrames."""
