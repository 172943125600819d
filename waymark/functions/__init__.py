"""Column functions and the small numpy helpers behind Arrow UDFs."""
