"""aeromill operators."""
