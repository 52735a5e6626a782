"""Column functions: text features of a pair, fuzzy ratios, numeric similarity."""
