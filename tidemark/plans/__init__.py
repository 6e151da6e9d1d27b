"""What to load, in which order, and what was loaded."""
