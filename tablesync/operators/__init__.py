"""Pure DataFrame operators: no side effects, no collected rows."""
