"""Where observations come from: files, listing payloads, messages, star tables."""
