"""Column functions: dates and stamps, names and labels, JSON maps."""
