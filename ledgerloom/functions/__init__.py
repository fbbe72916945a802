"""Column functions: plain expressions, all inside code generation."""
