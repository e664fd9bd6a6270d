"""Geospatial network and coverage analytics as plain Spark DataFrame operators."""
