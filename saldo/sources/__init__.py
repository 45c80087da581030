"""Sources and stored tables."""
