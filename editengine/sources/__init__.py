"""Readers: raw feed, layer tables, edit store, and the events adapter."""
