"""Column expressions: text, maths, JSON and rubric scoring."""
