"""Readers and writers: headered CSV, positional TSV, text lines, JSON lines, lookups."""
