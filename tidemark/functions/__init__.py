"""Scalar column functions (JVM built-ins; NFKC is the one pandas UDF)."""
