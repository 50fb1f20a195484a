"""Sources: readers, parsers and normalisation of landed data."""
