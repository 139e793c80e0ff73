"""Structured Streaming: landed files to Bronze, windowed energy, Silver kept up to date."""
