"""Layered prescribing-ledger analytics expressed as Spark DataFrame jobs.

Raw monthly records and web pages (Bronze) become a typed table (Silver), aggregates and a
versioned practice dimension (Gold), term frequencies, micro-batch streams and quality reports.
"""
