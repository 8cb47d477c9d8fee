"""Relational operators over bar tables: cleaning, chunking, order flow, quality."""
