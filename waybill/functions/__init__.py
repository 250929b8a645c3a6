"""Column expressions: scalar rules, geography, time parts and digests."""
