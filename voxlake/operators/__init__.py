"""Relational and volumetric operators."""
