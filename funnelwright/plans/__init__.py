"""The marts and loads, each a lazy DataFrame over its inputs."""
