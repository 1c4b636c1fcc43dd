"""Jobs, sinks, run layout and the query catalogue."""
