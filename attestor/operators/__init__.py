"""operators of attestor."""
