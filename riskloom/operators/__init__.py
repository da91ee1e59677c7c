"""Table operators: histograms, ranks, bins, encodings, metrics, splits."""
