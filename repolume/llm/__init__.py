"""Operators that prepare text corpora for training language models.

One module per operator; ``queries`` applies each of them to whole test tables. Nothing else in the library imports
this subpackage. Every operator takes a frame with the columns it names, in any order and beside any others.
"""
