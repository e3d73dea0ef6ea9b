"""Part of gridwatch."""
