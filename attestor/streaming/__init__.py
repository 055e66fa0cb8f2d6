"""streaming of attestor."""
