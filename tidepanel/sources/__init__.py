"""Scans, sinks, staged tables and the fixture views."""
