"""Input tables, output tables and scratch space."""
