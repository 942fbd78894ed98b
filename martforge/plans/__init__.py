"""Plans: the star model, layered loads, the daily jobs and the query catalog."""
