"""Column expressions (pure, codegen-friendly)."""
