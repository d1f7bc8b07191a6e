"""Table bindings and the registered query catalogue."""
