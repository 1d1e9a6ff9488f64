"""Column expressions; nothing here needs a Python function per row."""
