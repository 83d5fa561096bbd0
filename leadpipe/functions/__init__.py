"""Column -> Column expressions; everything but `similarity` stays in the JVM."""
