"""Whole jobs (batch run) and the registered queries over the driver tables."""
