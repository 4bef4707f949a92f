"""Column helpers: text, numbers, time, predicates and business classifiers."""
