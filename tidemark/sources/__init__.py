"""Reading tables and staged files."""
