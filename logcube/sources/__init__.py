"""Connectors: raw JSON logs, the JDBC catalog, fact tables, report sinks,
and the bridge from the driver's test tables to the reference data shape."""
