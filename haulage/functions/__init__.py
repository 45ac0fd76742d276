"""Column expressions. Nothing here triggers a job and nothing leaves the JVM."""
