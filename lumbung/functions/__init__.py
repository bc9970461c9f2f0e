"""Column -> Column helpers built from Catalyst functions only."""
