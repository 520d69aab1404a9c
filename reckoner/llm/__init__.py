"""Operators of a training-data pipeline over the documents of a corpus.

Every operator takes and returns DataFrames and names the columns it reads, so
further columns of its inputs, whatever their names, change nothing. Texts are
read whole. What tasks hold does not grow with the corpus; what is broadcast
has a bound that each module states.
"""
