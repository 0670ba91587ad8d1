"""Reading raw files and reading and writing the mart's tables."""
