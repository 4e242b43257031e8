"""Building blocks: decode, check, merge, filter, ingest, compare. DataFrame in, DataFrame out."""
