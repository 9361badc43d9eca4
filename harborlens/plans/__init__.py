"""Plans: bindings, oracle SQL and the query catalog."""
