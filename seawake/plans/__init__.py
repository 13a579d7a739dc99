"""One module per product: the four kinds of published events."""
