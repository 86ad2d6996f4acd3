"""Where readings come from and where views are stored."""
