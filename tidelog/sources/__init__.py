"""Where rows come from and go to: topic tables, given tables as topics, generated rows."""
