"""DataFrame operators; see the module docstrings for the operator ids."""
