"""DataFrame operators: selection, joins, proof, windows, gates."""
