"""Column expressions. Every function takes and returns Spark columns and runs in the JVM."""
