"""Column helpers. Each one returns a Column and runs inside the JVM."""
