"""Registered queries over the star-schema tables, each beside its SQL check."""
