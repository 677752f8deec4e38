"""The tables of the lodging model, layer by layer."""
