"""Readers: raw text, archives, listings, stations, staged tables."""
