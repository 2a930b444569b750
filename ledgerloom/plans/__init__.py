"""Plans: the star built from driver tables, marts, the pipeline, the catalogue."""
