"""Column-expression builders. Each returns a ``Column``; all stay JVM-side (no Python UDFs)."""
