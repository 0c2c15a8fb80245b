"""Relational operators: each takes and returns DataFrames and is lazy unless it says otherwise."""
