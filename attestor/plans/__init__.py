"""plans of attestor."""
