"""Column functions: text, times, places and nested values."""
