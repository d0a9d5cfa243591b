"""Column expressions and measure definitions shared by all reports."""
