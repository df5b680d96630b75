"""Lazy DataFrame operators for enriching, totalling, skew-proof joining and measuring large Spark tables."""
