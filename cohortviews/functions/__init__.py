"""Column expressions: all built-in functions, nothing leaves the JVM."""
