"""Readers: the given tables and the workshop inputs derived from them, JSON
landing folders, and generated feeds."""
