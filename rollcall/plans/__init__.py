"""Dataset definitions, data-quality checks and analyst queries."""
