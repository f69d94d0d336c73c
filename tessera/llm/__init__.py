"""Training-data operators: search, dedup, joins, tokenizers, packing and classifiers over text corpora."""
