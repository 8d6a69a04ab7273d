"""Where the staging tables come from and where results go."""
