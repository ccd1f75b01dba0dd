"""The pipeline job, and the registered queries with their SQL twins."""
