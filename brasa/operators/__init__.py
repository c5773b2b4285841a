"""DataFrame operators the named models are built from."""
