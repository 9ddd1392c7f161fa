"""Sources and sinks: readers with explicit schemas, fixture views, result writers."""
