"""Column expressions: everything here is evaluated by the JVM, no Python workers."""
