"""Training-data operators (language id, secrets, duplicates, tokens, packing,
quality). Nothing else in the package imports this subpackage."""
