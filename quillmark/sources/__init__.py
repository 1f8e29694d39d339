"""Readers and landed tables. Nothing is fetched: pages and extracted issues land as tables first."""
