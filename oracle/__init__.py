"""SQL that recomputes every registered query on the driver's tables, for checking only."""
