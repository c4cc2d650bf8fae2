"""Column functions: text, physics, output names."""
