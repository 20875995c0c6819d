"""One thin query per operator: it applies the operator to its table and derives digest columns."""
