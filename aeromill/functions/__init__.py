"""aeromill functions."""
