"""The query language: parsing, rewriting, compiling to DataFrames."""
