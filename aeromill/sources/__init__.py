"""aeromill sources."""
