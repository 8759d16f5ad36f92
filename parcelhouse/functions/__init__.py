"""Column expressions shared by the table builds."""
