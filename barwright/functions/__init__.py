"""Indicator functions: registry, native window builders, Arrow kernels."""
