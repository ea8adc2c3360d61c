"""Relational operators over chunks, questions, titles and resources."""
