"""Sources and sinks: page envelopes, JSON folders, catalog tables."""
