"""Column-returning helpers: everything stays inside JVM code generation."""
