"""Replaying ledger records as checkpointed micro-batches."""
