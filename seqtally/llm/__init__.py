"""Training-data operators: token output, quality scores, WARC archives,
language spans, near and substring duplicates, BPE, chat formatting and
benchmark decontamination.  Nothing else in the library imports this package;
``queries.py`` holds the registered queries and their SQL."""
