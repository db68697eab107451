"""Readers for landed files and the slices jobs take from them."""
