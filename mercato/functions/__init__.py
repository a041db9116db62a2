"""Column helpers: exact money and ratio arithmetic, bands, and label text."""
