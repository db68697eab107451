"""DataFrame operators the marts and loads are built from."""
