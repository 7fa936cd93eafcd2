"""Column expressions: deterministic identities, text normalisation, rendering."""
