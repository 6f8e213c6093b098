"""Column expressions: nothing here reads, shuffles or collects data."""
