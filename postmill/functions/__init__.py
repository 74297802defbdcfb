"""Column expressions: each takes and returns ``Column`` and stays in the JVM."""
