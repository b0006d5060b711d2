"""Column functions; every one stays inside generated JVM code."""
