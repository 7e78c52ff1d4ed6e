"""Plain SQL for every registered query, written for a second engine."""
