"""Table access, landing folders and stand-in tables."""
