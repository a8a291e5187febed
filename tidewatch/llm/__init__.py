"""Training-data preparation: the ten corpus operators, one module each.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and returns DataFrames; Python runs only inside tasks, on Arrow
batches or on groups whose size is bounded.
"""
