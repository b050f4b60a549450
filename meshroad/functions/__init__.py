"""Column-level building blocks: parsing and spherical geometry."""
