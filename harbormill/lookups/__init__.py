"""Parameterised queries. User text only ever becomes a literal, never SQL."""
