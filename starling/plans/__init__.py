"""Compositions: the results a user asks for."""
