"""Jobs composed from operators, and the registry of checked queries."""
