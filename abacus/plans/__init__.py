"""Plans: the warehouse models, their build order, and serving."""
