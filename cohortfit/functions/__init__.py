"""Column functions: hashing, fixed-point gradients, metric formulas, boosted-tree traversal."""
