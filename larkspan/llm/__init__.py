"""Operators of a training-data pipeline, one module each.

1 bpe, 2 linededup, 3 simhash, 4 crosspolytope, 5 mixing, 6 langid, 7 onebit, 8 toxicity, 9 ring, 10 mixlm,
11 spelling, 12 chat, 13 collocations.
`queries` registers them; nothing else in the library imports this package.
"""
