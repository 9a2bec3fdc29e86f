"""Plans: fixture projections, stage compositions and the query registry."""
