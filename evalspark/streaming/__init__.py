"""Call logs that are read while they are written."""
