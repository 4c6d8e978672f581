"""Report plans (R1-R16) and the query registry."""
