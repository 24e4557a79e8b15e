"""Where records come from and where results go."""
