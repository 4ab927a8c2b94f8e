"""tidemark: landed raw data to validated, lineage-stamped tables, as Spark jobs."""
