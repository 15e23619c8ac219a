"""DataFrame -> DataFrame operators of the reports."""
