"""Operators for building training corpora; each module's docstring states its rules."""
