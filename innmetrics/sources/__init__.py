"""Input tables and serving tables."""
