"""Operators for training corpora: documents, vectors and token ids. Nothing else in the package imports this one."""
