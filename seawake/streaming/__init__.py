"""Batch-incremental state: reload, merge and upsert of open events."""
