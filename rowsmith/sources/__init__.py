"""Readers and writers: the only place where files appear."""
