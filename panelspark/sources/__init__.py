"""Scans and sinks: testbed panels, CSV ingest/normalisation, Parquet/CSV writers."""
