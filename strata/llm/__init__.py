"""Operators a training-data pipeline needs, over tables of documents and chats."""
