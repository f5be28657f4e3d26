"""DataFrame -> DataFrame steps; all lazy unless their docstring says otherwise."""
