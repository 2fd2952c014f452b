"""Plans: named queries over the driver tables, their SQL oracles, and the
job functions that write tables."""
