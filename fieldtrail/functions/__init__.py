"""Column expressions and driver-side name planning."""
