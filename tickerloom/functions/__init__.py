"""Column builders: native expressions only, no Python runs per row."""
