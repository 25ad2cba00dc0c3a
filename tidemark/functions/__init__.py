"""Column-level expressions: coercion, names, text, identifiers, detectors."""
