"""Training-data operators: one module per operator, one query module.

Nothing outside this folder imports it; removing it leaves the rest of the library whole.
"""
