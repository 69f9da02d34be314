"""Incident records and an activity log, joined and rendered as training records with Spark."""
