"""Column expressions: no I/O, no joins, no shuffles."""
