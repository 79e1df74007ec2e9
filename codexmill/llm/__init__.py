"""Operators on texts for training corpora; nothing else imports this package."""
