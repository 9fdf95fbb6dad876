"""Where data comes from and goes to: configuration, reference tables, messages, files."""
