"""Operators on document texts and identities for training corpora. Nothing else in the library imports this package."""
