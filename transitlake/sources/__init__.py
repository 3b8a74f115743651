"""Sources and sinks of the lake."""
