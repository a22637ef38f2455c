"""The reports. Each takes posts and returns a DataFrame; nothing is collected."""
