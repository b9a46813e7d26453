"""Where messages and keyed results go."""
