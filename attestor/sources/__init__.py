"""sources of attestor."""
