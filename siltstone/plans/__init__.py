"""The four layer jobs."""
