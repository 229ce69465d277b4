"""Readers and writers: ledger CSV, Bronze JSON lines, page documents, lake inventory."""
