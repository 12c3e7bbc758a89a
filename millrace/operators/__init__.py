"""DataFrame operators; import the modules, e.g. ``from millrace.operators import quality``."""
