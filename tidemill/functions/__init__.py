"""Column expressions: text, dates, numbers and JSON, all built-in and JVM-side."""
