"""functions of attestor."""
