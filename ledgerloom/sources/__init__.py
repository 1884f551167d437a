"""Readers and writers: wide rate files, catalog listings, table layouts,
schema copies and published versions."""
