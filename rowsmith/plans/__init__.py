"""Composite jobs and the registered queries."""
