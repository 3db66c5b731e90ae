"""Column functions: cryptography, classification and text rules."""
