"""Column functions: text normalisation, statistics, units."""
