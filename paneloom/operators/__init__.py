"""Reusable DataFrame operators, generic over column names."""
