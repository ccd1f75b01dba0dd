"""Landing directory, Parquet / CSV sources, layer tables and the load ledger."""
