"""Column functions: Column in, Column out, no actions and no UDFs."""
