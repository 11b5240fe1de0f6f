"""Readers for line files, message envelopes and tables."""
