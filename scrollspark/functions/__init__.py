"""Column functions: parsing, identifiers, payload checks and nested OCR documents."""
