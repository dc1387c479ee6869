"""Reading, writing, staging and generating tables."""
