"""Composite jobs and the registered query set."""
