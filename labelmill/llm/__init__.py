"""Operators for preparing training data: samples, sketches, survivors, tokens, packing, repair."""
