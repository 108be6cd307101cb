"""Column expressions: text rules, arrays, annotation spans, keys."""
