"""Column-level helpers; every one stays inside whole-stage code generation."""
