"""Analog relations over the synthetic tables and the registered query set."""
