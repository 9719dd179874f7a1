"""Read commands, keyed state, changes, windows, writes and queues over topic logs."""
