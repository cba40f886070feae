"""Sides (named sets of tables), versioned exports, and schema texts."""
