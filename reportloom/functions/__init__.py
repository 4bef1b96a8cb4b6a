"""Column builders: every function here returns a ``Column`` and runs no job."""
