"""Readers, writers, and the star-schema stand-ins for the French open data."""
