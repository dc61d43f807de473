"""Part of the tidings package."""
