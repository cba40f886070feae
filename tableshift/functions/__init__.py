"""Column-expression builders. Everything here stays inside JVM code generation."""
