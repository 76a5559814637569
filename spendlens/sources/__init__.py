"""Table contracts and lake access."""
