"""Training-data operators: text, vectors and web pages prepared at corpus scale."""
