"""Column expressions and driver-side settings (templates, tokenizers)."""
