"""The registered queries, their SQL twins, and the data they derive from the given tables."""
