"""Column expressions with no aggregate or window, safe on batch and stream."""
