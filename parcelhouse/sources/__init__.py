"""Where tables come from and where they are kept."""
