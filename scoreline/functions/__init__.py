"""Part of scoreline."""
