"""The workflow: validate, prepare features, train, gate, register, score."""
