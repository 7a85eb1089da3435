"""tamiz: curation of text corpora and question-answer datasets on Spark DataFrames."""

__version__ = "0.1.0"
