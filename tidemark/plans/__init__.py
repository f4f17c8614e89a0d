"""Job plans: fixtures built from the given tables, monitoring, reports."""
