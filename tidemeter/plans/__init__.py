"""Compositions a user calls."""
