"""Jobs, domain bindings of the driver's tables, and the query catalogue."""
