"""Training-data operators on text and web pages; nothing outside this folder imports it."""
