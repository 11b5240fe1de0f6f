"""Column expressions: framing, CDC metadata, validation rules, shaping."""
