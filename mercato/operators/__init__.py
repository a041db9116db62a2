"""Row and set operators: cleaning, customer totals, tiles, quality checks, export forms."""
