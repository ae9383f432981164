"""Column expressions shared by the operators. All of them stay inside the JVM."""
