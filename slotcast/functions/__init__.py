"""Column-level functions: calendar, Fourier, domain, cleaning and sign helpers."""
