"""Plans: the lazy layer model, the materialised pipeline, view DDL and the query registry."""
