"""Event stream: parse, land, resume."""
