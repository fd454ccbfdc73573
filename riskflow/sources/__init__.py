"""Scans, sinks and the stand-in fixtures."""
