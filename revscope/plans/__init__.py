"""Job-level plans: the batch pipeline, the SQL surface and the query registry."""
