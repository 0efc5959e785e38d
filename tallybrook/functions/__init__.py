"""Column expressions shared by the jobs; all of them stay in the JVM."""
