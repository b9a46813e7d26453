"""Where messages and the address dictionary come from."""
