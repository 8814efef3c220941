"""Contract queries: the reference's jobs re-expressed on the driver tables."""
