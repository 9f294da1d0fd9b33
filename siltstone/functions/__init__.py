"""Column builders: rules, casts, means."""
