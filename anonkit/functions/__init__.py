"""Column functions: every one maps Columns to a Column and stays inside whole-stage codegen."""
