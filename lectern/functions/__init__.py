"""Column functions: everything here stays an expression inside the JVM."""
