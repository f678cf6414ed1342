"""Readers and writers: the reference's Parquet files and the fixture tables."""
