"""Column builders over VARIANT records and typed structs."""
