"""Column expressions (JVM-side built-ins) and small per-row helpers."""
