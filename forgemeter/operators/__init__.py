"""DataFrame operators: ingest, staging, ordering, ranking and data tests."""
