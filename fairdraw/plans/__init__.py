"""Plans behind the operators: quotas, selection of the smallest priorities,
skew-safe lookups and exact order statistics."""
