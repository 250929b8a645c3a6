"""Business tables per layer: bronze, silver, gold, features, quality."""
