"""Scans, sinks and adapters from the driver tables to the library contracts."""
