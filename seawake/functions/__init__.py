"""Column functions: no DataFrame, no shuffle, all inside generated code."""
