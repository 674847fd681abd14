"""Relational operators: rules, views, state merges and similarity joins."""
