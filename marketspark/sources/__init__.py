"""Readers, parsers of raw payloads, canonical views and writers."""
