"""Errors that say what is wrong with a source, not with the code."""


class SourceError(ValueError):
    """A table lacks columns or fields that an operator needs."""
