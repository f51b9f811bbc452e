"""Column functions: native expressions only, so plans stay inside code generation."""
