"""Conversational-data curation and corpus preparation on Spark DataFrames."""
