"""Report plans: specs of the report families, one-pass backfill, daily job."""
