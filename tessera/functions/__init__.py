"""Column-expression helpers (Strassen coefficients) and per-tile numpy helpers."""
