"""Hydrographic network analytics written for Spark."""
