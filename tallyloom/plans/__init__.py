"""Feature families and their assembly."""
