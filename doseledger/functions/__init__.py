"""Column expressions shared by every operator. All of them stay inside the JVM."""
