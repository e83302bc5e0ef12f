"""Column-to-column functions, all inside the JVM's generated code."""
