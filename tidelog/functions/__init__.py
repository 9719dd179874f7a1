"""Column helpers and the skew-proof ordered scan that the operators share."""
