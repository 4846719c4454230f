"""Column functions. All run in the JVM."""
