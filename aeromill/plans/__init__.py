"""aeromill plans."""
