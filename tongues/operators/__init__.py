"""DataFrame operators: links, sentences, set operations, sampling, n-grams, evaluation."""
