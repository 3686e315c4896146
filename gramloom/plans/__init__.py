"""Physical choices shared by the operators: scratch tables, skew-safe lookups."""
