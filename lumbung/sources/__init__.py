"""Readers, sinks and fixed lookup tables."""
