"""Column expressions (JVM-side, codegen-friendly): names, paths, dates, sizes, value classes."""
