"""Column helpers: each takes and returns Column expressions that stay inside the JVM."""
