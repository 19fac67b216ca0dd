"""Where claims data comes from: raw extracts and warehouse tables."""
