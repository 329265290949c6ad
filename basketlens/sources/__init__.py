"""Reading purchases and keeping intermediate tables."""
