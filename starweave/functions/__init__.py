"""Column factories (all JVM-side built-in expressions, no Python UDFs)."""
