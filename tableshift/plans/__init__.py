"""Jobs built from the operators: verify a copy, move a side, release table changes, pass the gate."""
