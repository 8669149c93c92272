"""Plans: month drivers, the bridge plan with its cut points, the query registry."""
