"""Record, table, live-table and topic-maintenance operators."""
