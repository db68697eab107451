"""Shared by the tests of this folder."""


def lower_ascii(text):
    return "".join(c.lower() if c.isascii() else c for c in text)
