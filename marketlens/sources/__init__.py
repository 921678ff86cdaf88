"""Sources: landing-file readers, the holiday dimension, and the adapters
that turn the driver's tables into market data."""
