"""Column helpers: text cleaning and numeric rules. All of them stay inside the JVM."""
