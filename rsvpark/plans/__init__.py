"""Query plans: the named driver queries and the report tables."""
