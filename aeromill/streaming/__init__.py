"""aeromill streaming."""
