"""Column expressions and the small in-task helpers behind the operators."""
